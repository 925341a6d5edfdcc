"""Exact copies, mixing, language, near copies and the pipeline beside brute-force versions."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import documents, edges, no_documents, prose  # noqa: F401

from barloom.llm import exact_dedup, language_id, mixing, near_dedup, stages
from barloom.llm.common import id_crc
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def brute_groups(docs):
    groups = defaultdict(list)
    for d in docs:
        groups[d.text or ""].append(d.doc_id)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return [(d.doc_id, top[d.text or ""], len(groups[d.text or ""]), hashlib.sha256((d.text or "").encode()).hexdigest()) for d in docs]


@pytest.mark.parametrize("first,growth", [(64, 16), (1, 2)])
def test_exact_groups(edges, first, growth):
    got = exact_dedup.exact_groups(edges, first, growth)
    assert rows(got.select("doc_id", "keep_id", "group_size", "text_sha256")) == sorted(brute_groups(edges.collect()), key=repr)
    kept = got.where("kept").groupBy("text_sha256").count().collect()
    assert all(r["count"] == 1 for r in kept) and len(kept) == len({d.text or "" for d in edges.collect()})
    assert got.where("kept AND NOT doc_id <=> keep_id").isEmpty()


def test_exact_dedup_keeps_columns(edges, no_documents):
    kept = exact_dedup.exact_dedup(edges)
    assert kept.columns == edges.columns and kept.count() == len({d.text or "" for d in edges.collect()})
    assert exact_dedup.exact_dedup(no_documents).count() == 0


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, clamped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in clamped]
        level = (total - sum(3 * sizes[s] for s in clamped)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: float(3 * sizes[s]) if s in clamped else weight[s] * level for s in order}
        clamped |= over


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_mix(request, name):
    docs = request.getfixturevalue(name)
    got = mixing.mix(docs, ["doc_id", "source"]).collect()
    sizes = Counter()
    for d in docs.collect():
        sizes[d.source] += len(re.findall(r"[^\x20\x09-\x0D]+", d.text or ""))
    want, taken, largest = brute_targets(sizes), Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], abs=1e-5)
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-3 for s in sizes)
    assert len(got) == docs.count()
    again = mixing.mix(docs.repartition(2), ["doc_id", "source"], range_rows=3)
    assert rows(again) == sorted(map(tuple, got), key=repr)


def test_mixed_documents(edges, no_documents):
    mixed = mixing.mixed_documents(edges)
    assert mixed.columns == edges.columns
    copies = mixing.mix(edges, ["doc_id"])
    assert mixed.count() == copies.agg(F.sum("copies")).first()[0]
    assert mixing.mixed_documents(no_documents).count() == 0


def longest_match(text, at, source):
    n = 0
    while at + n < len(text) and text[at:at + n + 1] in source:
        n += 1
    return n


def test_cross_parsing_counts_greedy_phrases():
    source = "the other thing is that the weather here"
    parser = language_id.CrossParser((("en", source),))
    for text in ("the weather thing", "zzz the", "here there that", "q", ""):
        at = phrases = 0
        coded = language_id.letters_only(text)
        while at < len(coded):
            at += max(1, longest_match(coded, at, source))
            phrases += 1
        got = sum(c.sum() for lanes, _ in parser.lanes([text]) for c in parser.phrases(lanes))
        assert got == phrases


def test_language_accuracy_on_held_out(documents):
    held_out = id_crc() % 5 == 0
    model = language_id.training_text(documents, ~held_out)
    assert all(len(t) <= language_id.TRAIN_CHARS for t in model.values())
    got = language_id.predict(documents.withColumn("held", held_out), model, ["doc_id", "lang", "held"]).select("_row.*", "lang_pred", "score").collect()
    judged = [r for r in got if r.held and r.lang]
    assert len(got) == documents.count() and sum(r.lang_pred == r.lang for r in judged) >= 0.95 * len(judged)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(edges, no_documents):
    model = language_id.training_text(edges, F.lit(True))
    got = language_id.predict(edges, model, edges.columns).select("_row.doc_id", "_row.text", "lang_pred", "score").collect()
    for r in got:
        wordless = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == wordless and (r.score == 0 or not wordless)
    assert language_id.training_text(no_documents, F.lit(True)) == {}
    unlearned = language_id.predict(edges, {}, ["doc_id"])
    assert {r.lang_pred for r in unlearned.collect()} == {"und"}
    assert language_id.predict(no_documents, model, ["doc_id"]).count() == 0


def test_language_of_a_few_copied_texts_is_learned(spark, documents):
    own = [" ".join(f"{a}{b}q{c}" for a in "kzx" for b in "öüy" for c in f"{i:02d}wv"[i % 3:]) + f" žluť {prose(i, 30)[::-1]}" for i in range(20)]
    copies = spark.createDataFrame([(1_000_000 + i * 20 + j, t, "xx") for i in range(100) for j, t in enumerate(own)], "doc_id long, text string, lang string")
    both = documents.select("doc_id", "text", "lang").union(copies)
    model = language_id.training_text(both, id_crc() % 5 != 0)
    again = language_id.training_text(both.repartition(3), id_crc() % 5 != 0)
    assert model == again and len(model["xx"]) >= 20 * 40  # each distinct text once, in one order
    got = language_id.predict(both, model, ["doc_id", "lang"]).select("_row.lang", "lang_pred").where("lang = 'xx'").collect()
    assert sum(r.lang_pred == "xx" for r in got) >= 0.95 * len(got)


def test_language_stage_fills_and_rejects(spark, documents):
    named = documents.where("length(text) >= 200").select("doc_id", "text", "lang")
    english, german = (named.where(F.col("lang") == c).orderBy("doc_id").first() for c in ("en", "de"))
    planted = spark.createDataFrame(
        [(900_001, german.text, None), (900_002, german.text, "en"), (900_003, "und", "fr"), (900_004, english.text, "en"), (900_005, "7", "en")], named.schema)
    kept = stages.identified(spark, named.union(planted), "")
    assert kept.columns == named.columns
    assert {r.doc_id: r.lang for r in kept.where("doc_id > 900000").collect()} == {900_001: "de", 900_003: "fr", 900_004: "en"}
    assert kept.where("doc_id <= 900000").count() == named.count()


def brute_shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return Counter()
    words += [b""] * (5 - len(words))
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_similarity(a, b):
    if not a or not b:
        return 0.0
    plain = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    weighted = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())
    return max(plain, weighted)


def brute_classes(docs):
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [brute_shingles(d.text) for d in docs]
    for i in range(len(docs)):
        for j in range(i):
            if (docs[i].text or "") == (docs[j].text or "") or (
                    sets[i].keys() & sets[j].keys() and brute_similarity(sets[i], sets[j]) >= 0.8):
                parent[find(i)] = find(j)
    classes = defaultdict(list)
    for i, d in enumerate(docs):
        classes[find(i)].append(d.doc_id)
    return sorted((sorted(c, key=repr) for c in classes.values()), key=repr)


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_near_classes(request, name):
    docs = request.getfixturevalue(name)
    got = near_dedup.near_classes(docs).collect()
    classes, kept = defaultdict(list), Counter()
    for r in got:
        key = r.class_id if r.class_id is not None else r.text_sha256
        classes[key].append(r.doc_id)
        kept[key] += r.kept
    assert sorted((sorted(c, key=repr) for c in classes.values()), key=repr) == brute_classes(docs.collect())
    assert set(kept.values()) == {1} and all(r.class_size == len(classes[r.class_id if r.class_id is not None else r.text_sha256]) for r in got)


def test_hot_group_of_near_copies_is_one_class(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [(i, " ".join([*base[:40 + i % 50], f"v{i}", *base[41 + i % 50:]])) for i in range(300)]
    texts += [(1_000 + i, " ".join(f"u{i}x{j}" for j in range(60))) for i in range(20)]
    got = near_dedup.near_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.class_id for r in got if r.doc_id < 1_000} == {299} and len({r.class_id for r in got}) == 21


def test_pairs_between_template_pages_are_found(spark):
    """Pages alike at 0.6 fill the buckets; planted pairs at 0.8 to 0.85 are neither leaders nor of a led class."""
    template = [f"t{j}" for j in range(150)]
    texts = []
    for i in range(1_000):
        own = [f"o{i // 2 if i < 500 else i}x{j}" for j in range(50)]
        if i < 500 and i % 2:
            own[:] = [*own[:-17 - i % 5], *(f"p{i}x{j}" for j in range(17 + i % 5))]
        texts.append((i * 7_919 % 1_009, " ".join(template + own)))
    sets = [brute_shingles(t) for _, t in texts]
    place = {s: k for k, s in enumerate({s for x in sets for s in x})}
    held = np.zeros((len(sets), len(place)), np.float32)
    for i, x in enumerate(sets):
        held[i, [place[s] for s in x]] = 1
    both, sizes = held @ held.T, held.sum(1)
    alike = np.argwhere(np.triu(both / (sizes[:, None] + sizes - both) >= 0.8, 1)).tolist()
    assert len(alike) == 250
    expected = {i: i for i, _ in texts} | {min(texts[a][0], texts[b][0]): max(texts[a][0], texts[b][0]) for a, b in alike}
    got = near_dedup.near_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == expected


def test_unlinked_template_pages_do_not_meet(spark, monkeypatch):
    """Pages alike at 0.72 by a template: compared pairs grow with the pages, not with their square."""
    compared, verified = [], near_dedup._verified

    def counting(pairs, texts):
        compared.append(pairs.count())
        return verified(pairs, texts)

    monkeypatch.setattr(near_dedup, "_verified", counting)
    texts = [(i, " ".join([*(f"t{j}" for j in range(163)), *(f"o{i}x{j}" for j in range(33))])) for i in range(400)]
    got = near_dedup.near_classes(spark.createDataFrame(texts, "doc_id long, text string"))
    assert got.select("class_id").distinct().count() == 400 and sum(compared) < 12 * 400


def test_outsiders_of_a_hot_class_do_not_meet_its_members(spark, monkeypatch):
    """Near copies of one text in a class, and texts alike below the threshold to each of them: few pairs, all links found."""
    compared, verified = [], near_dedup._verified

    def counting(pairs, texts):
        compared.append(pairs.count())
        return verified(pairs, texts)

    draw = random.Random(8)

    def changed(places, i):
        words = [f"w{j}" for j in range(150)]
        for k in places:
            words[k] = f"v{i}x{k}"
        return " ".join(words)

    # spread changes cost five shingles each: 1 or 2 in members, 4 in outsiders; the last ten outsiders have a partner
    places = [sorted(draw.sample(range(6, 144, 6), 1 + i % 2 if i < 300 else 4)) for i in range(400)]
    texts = [(i, changed(p, i)) for i, p in enumerate(places)]
    texts += [(500 + i, changed(places[390 + i], 390 + i).replace("w149", f"z{i}")) for i in range(10)]
    sets = [brute_shingles(t) for _, t in texts]
    parent = {i: i for i, _ in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for j, (i, _) in enumerate(texts):
        for k in range(j):
            both = len(sets[j].keys() & sets[k].keys())
            if both / (len(sets[j]) + len(sets[k]) - both) >= 0.8:
                parent[find(i)] = find(texts[k][0])
    monkeypatch.setattr(near_dedup, "_verified", counting)
    got = near_dedup.near_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r.class_id].add(r.doc_id)
    want = defaultdict(set)
    for i, _ in texts:
        want[find(i)].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert 1 < len(want) and max(map(len, want.values())) >= 300 and sum(compared) < 12 * len(texts)


def test_buckets_whose_leader_joined_none_get_no_further_leader(spark, monkeypatch):
    """Template pages alike at 0.79 in pairs alike at 0.8: a leader finds its partner at most; all are found by few pairs."""
    compared, verified = [], near_dedup._verified

    def counting(pairs, texts):
        compared.append(pairs.count())
        return verified(pairs, texts)

    monkeypatch.setattr(near_dedup, "_verified", counting)
    template = [f"t{j}" for j in range(886)]
    texts = [
        (i * 7_919 % 100_003, " ".join([*template, *(f"o{i // 2}x{j}" for j in range(5)), *(f"p{i}x{j}" for j in range(109))]))
        for i in range(120)
    ]
    sets = [brute_shingles(t) for _, t in texts]
    assert brute_similarity(sets[0], sets[1]) >= 0.8 > brute_similarity(sets[1], sets[2])
    got = near_dedup.near_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: max(texts[k - k % 2][0], texts[k + 1 - k % 2][0]) for k, (i, _) in enumerate(texts)}
    assert sum(compared) < 6 * len(texts)


def test_components_drop_links_inside_classes(spark, monkeypatch):
    """A hot star, a path in random order and small trees: the links of a class are read once, not in every round."""
    draw, order = random.Random(5), list(range(1_000, 1_300))
    draw.shuffle(order)
    links = [(i, 700) for i in range(600)] + list(zip(order, order[1:])) + [(i, draw.randrange(2_000, i)) for i in range(2_001, 2_200)]
    links += [(b, a) for a, b in links[::3]] + links[::4] + [(3_000, 3_000)]
    made, stage = [], near_dedup.stage

    def counting(df, purpose):
        out = stage(df, purpose)
        made.append((purpose, out.count()))
        return out

    monkeypatch.setattr(near_dedup, "stage", counting)
    none = spark.createDataFrame([], "node long, label long")
    labels = near_dedup.components(spark.createDataFrame(links, "a long, b long"), none)
    want = {i: 0 for i in (*range(1, 600), 700)} | {i: 1_000 for i in range(1_001, 1_300)} | {i: 2_000 for i in range(2_001, 2_200)}
    assert labels.count() == len(want) and {r.node: r.label for r in labels.collect()} == want
    assert sum(n for purpose, n in made if purpose == "near-edges") < 2 * len(links)
    made.clear()
    joined = near_dedup.components(spark.createDataFrame([(1_200, 2_100), (2_050, 1_100), (5, 6)], "a long, b long"), labels)
    assert {r.node: r.label for r in joined.collect()} == want | {i: 1_000 for i in range(2_000, 2_200)}
    assert sum(n for purpose, n in made if purpose == "near-edges") == 1


def test_pairs_with_unequal_repeats_are_found(spark):
    """Equal shingle sets, of which one text repeats a part: J_P is low, the set Jaccard is 1 or near it."""
    texts = []
    for i in range(20):
        words = [f"w{i}x{j}" for j in range(200)]
        menu = (words[:20] + words[:4]) * (1 + i % 2 * 49)
        texts += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(menu + words))]
    got = near_dedup.near_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    sets = {i: brute_shingles(t) for i, t in texts}
    assert all(brute_similarity(sets[2 * i], sets[2 * i + 1]) >= 0.8 for i in range(20))
    assert {r.doc_id: r.class_id for r in got} == {i: i | 1 for i, _ in texts}


def test_near_dedup_rows(edges, no_documents):
    kept = near_dedup.near_dedup(edges)
    assert kept.columns == edges.columns and kept.count() == len(brute_classes(edges.collect()))
    assert near_dedup.near_dedup(no_documents).count() == 0


def test_similarity_and_signatures():
    a = Counter({i: 1 + i % 3 for i in range(90)})
    b = Counter({i: 1 + i % 2 for i in range(20, 100)})
    arrays = [(np.array(sorted(x), np.uint64), np.array([x[i] for i in sorted(x)])) for x in (a, b)]
    assert near_dedup.similarity(*arrays) == pytest.approx(brute_similarity(a, b))
    owner = np.repeat([0, 1], [len(a), len(b)])
    value = near_dedup._mix(np.concatenate([x for x, _ in arrays]) + np.uint64(1))
    size = 4_000
    signature = near_dedup.signatures(owner, value, np.concatenate([w for _, w in arrays]), 2, size)
    weighted = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())
    assert (signature[0] == signature[1]).mean() == pytest.approx(weighted, abs=4 * (0.25 / size) ** 0.5)


def test_pipeline_stages(spark, edges, documents):
    for docs in (edges, documents):
        local = docs.collect()
        named = stages.identified(spark, docs, "")
        lettered = [d for d in local if any(c.isalpha() for c in d.text or "")]
        assert named.columns == docs.columns and rows(named) == sorted(map(tuple, lettered), key=repr)
        single = stages.without_copies(spark, named, "")
        assert rows(single.select("text")) == sorted({(d.text,) for d in lettered}, key=repr)
        apart = stages.without_near_copies(spark, single, "")
        assert apart.columns == docs.columns and apart.count() == len(brute_classes(single.collect()))
        mixed = stages.mixed(spark, apart, "")
        copies = {(r.doc_id, r.text): r.copies for r in mixing.mix(apart, ["doc_id", "text"]).collect()}
        assert Counter((r.doc_id, r.text) for r in mixed.collect()) == Counter({k: n for k, n in copies.items() if n})
        pieces = stages.packed(spark, mixed, "").collect()
        assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(r.doc_id for r in mixed.collect())


def test_pipeline_runs(spark, sf_dir):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_a_worker_keeps_the_models_of_one_operator(edges):
    """Models of an earlier stage make room for the next one's; the same model is built once."""
    from barloom.llm import common

    built = []

    def parser():
        built.append(1)
        return object()

    first = common.only_model("languages", parser)
    assert common.only_model("languages", parser) is first and built == [1]
    near_dedup._task_hashes()
    assert list(common._held) == ["near_dedup"]
    common.only_model("languages", parser)
    assert built == [1, 1] and list(common._held) == ["languages"]


def test_pipeline_of_an_empty_table(spark, no_documents, tmp_path):
    import corpus_pipeline

    no_documents.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_id_crc(edges):
    for r in edges.select("doc_id", id_crc().alias("c")).collect():
        assert r.c == zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode())
