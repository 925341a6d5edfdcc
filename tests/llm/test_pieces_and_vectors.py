"""SentencePiece tables, fill-in-middle and whitening beside the library, a plain loop and numpy."""
import hashlib
import math
import re

import numpy as np
import pytest

from llm_fixtures import documents, edges, no_documents  # noqa: F401

from barloom.llm import fill_in_middle, queries, sentence_pieces, whitening
from pyspark.sql import functions as F

ODD = [
    "", " ", "  ", "▁", "▁▁ a", " lead", "trail ", "a  b   c", "tab\tand\nline\r\n", "x\0y \0", "中文字符没有空格" * 50, "🙂 👩‍👩‍👧 flags 🇩🇪",
    "ﬁ ligature ½", "<s> </s> <unk> <0x41>", " nbsp　wide", "1234567890 12 1", "x" * 20_000, "a " * 5_000, " ".join("ab" * k for k in range(60)),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "keep", b"_row") for i, t in enumerate([*ODD, None])] + [(None, "two words", None, None)] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, _row binary").repartition(3)


def model_file(folder, change):
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(sentence_pieces.model_path(), "rb") as f:
        spec.ParseFromString(f.read())
    change(spec)
    path = folder / "changed.model"
    path.write_bytes(spec.SerializeToString())
    return str(path)


def crossing(spec):
    spec.pieces[20_000].piece = "wo▁words"


def without_prefix(spec):
    spec.normalizer_spec.add_dummy_prefix = False


def single_spaces(spec):
    spec.normalizer_spec.remove_extra_whitespaces = True


@pytest.mark.parametrize("change", [None, crossing, without_prefix, single_spaces])
def test_pieces_equal_library(odd, tmp_path, change):
    path = model_file(tmp_path, change) if change else sentence_pieces.model_path()
    model = sentence_pieces.Pieces(path)
    assert model.cuts == (change is not crossing) and model.marked == (change in (None, single_spaces))
    encoded = sentence_pieces.encode(odd, ["doc_id", "text"], path, slice_chars=300)
    got = encoded.select("_row.*", "ids", sentence_pieces.decode(F.col("ids"), path).alias("back")).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in got) == sorted(repr((r.doc_id, r.text)) for r in odd.collect())
    for r in got:
        assert r.ids == model.full.encode(r.text or ""), r.text
        assert r.back == model.full.decode(r.ids)


def test_pieces_on_documents(spark, documents, no_documents):
    encoded = {r.doc_id: r.ids for r in sentence_pieces.encode(documents, ["doc_id"], slice_chars=10_000).select("_row.*", "ids").collect()}
    model = sentence_pieces.pieces(sentence_pieces.model_path()).full
    for r in documents.collect():
        assert encoded[r.doc_id] == model.encode(r.text or "")
    assert sentence_pieces.encode(no_documents, ["doc_id"]).count() == 0
    null = spark.createDataFrame([(None,), ([],)], "ids array<int>").select(sentence_pieces.decode(F.col("ids"))).collect()
    assert {r[0] for r in null} == {None, ""}


def test_each_chunk_segmented_once(monkeypatch):
    """The library sees a chunk once although many texts and slices hold it; a table beyond its bound starts anew."""
    model, asked = sentence_pieces.Pieces(sentence_pieces.model_path()), []
    real = model.segmented
    monkeypatch.setattr(model, "segmented", lambda keys: asked.extend(keys) or real(keys))
    texts = ["stone river  maple stone", "river stone " + "x" * 100, "", "maple " + "x" * 100]
    for _ in range(3):
        assert model.encode(texts).to_pylist() == [model.full.encode(t) for t in texts]
    assert sorted(set(asked)) == sorted(["stone", "river", "▁maple", "maple", "x" * 100])
    assert len(asked) == 5 + 2  # the long one is not kept for the next slices
    monkeypatch.setattr(sentence_pieces, "KEPT_CHUNKS", 2)
    assert model.encode(texts).to_pylist() == [model.full.encode(t) for t in texts] and len(asked) == 7 + 5


def test_pieces_query(spark, sf_dir):
    model = sentence_pieces.pieces(sentence_pieces.model_path()).full
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = model.encode(r.text or "")
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids))))
    assert set(map(tuple, queries.QUERIES["op11_pieces"](spark, sf_dir).collect())) == want


# --- fill-in-middle ---------------------------------------------------------


def brute_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("name", ["edges", "documents", "cases"])
def test_fill_in_middle(request, spark, name):
    if name == "cases":
        texts = [*ODD, None, "a <P> b", "a <S", "<S<S >M> <M", "$1 \\ $2 {3}", "\x0b\x0c\x85 x y", "word " * 200_000, "w" * 1_000_000]
        docs = spark.createDataFrame(
            [(i * 100 + k, t, "n", "form") for i, t in enumerate(texts) for k in range(12)], "doc_id long, text string, n string, output string"
        )
    else:
        docs = request.getfixturevalue(name)
    moved = fill_in_middle.fill_in_middle(docs, ["doc_id", "text"])
    got = moved.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).select("_row.*", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()
    assert len(got) == docs.count()
    for r in got:
        assert tuple(r)[2:7] == brute_middle(r.doc_id, r.text), (r.doc_id, (r.text or "")[:40])
        assert r.back == (r.text or "")
    if name != "edges":
        assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_fill_in_middle_runs_in_the_jvm(documents, no_documents):
    moved = fill_in_middle.fill_in_middle(documents, ["doc_id"])
    assert "Python" not in moved._jdf.queryExecution().executedPlan().toString()
    assert fill_in_middle.fill_in_middle(no_documents, ["doc_id"]).count() == 0


# --- whitening --------------------------------------------------------------


def checked_whitening(vectors, got, components=8):
    """Rows by id beside numpy's eigenvectors of the exactly summed covariance."""
    ids = list(vectors)
    x = [[math.floor(1024 * float(c)) + 100_000 for c in vectors[i]] for i in ids]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in x])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    rank = min(components, int((values > 1e-12 * max(values[0], 1e-300)).sum()))
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == set(ids) and all(set(v) == set(range(1, rank + 1)) for v in by.values())
    for i, row, whole in zip(ids, centred, x):
        for r in by[i].values():
            assert r.n == n and int(r.deviation) == sum((n * c - s) ** 2 for c, s in zip(whole, sums))
            assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-12 + 1e-15 * values[0] / values[r.component - 1])
            assert r.identity_error < 1e-8
    for k in range(rank):
        want = centred @ axes[:, k] / math.sqrt(values[k])
        have = np.array([by[i][k + 1].whitened for i in ids])
        gap = min((abs(values[k] - v) / values[0] for j, v in enumerate(values) if j != k), default=1.0)
        if gap > 1e-6 and values[k] > 1e-9 * values[0]:
            assert np.abs(have * np.sign(have @ want) - want).max() < 1e-7 + 1e-14 * values[0] / values[k]


def white(df, components=8):
    return whitening.whitened_components(df, ["vec_id"], components=components).select(
        "_row.*", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()


def test_whitening_of_embeddings(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = queries.QUERIES["op13_whitening"](spark, sf_dir).collect()
    checked_whitening({r.vec_id: r.embedding for r in df.collect()}, got)


def test_whitening_edges(spark):
    draw = np.random.default_rng(5)
    basis = draw.normal(size=(3, 6))
    vectors = {i: (draw.normal(size=3) * (30.0, 1.0, 0.05) @ basis).tolist() for i in range(60)}
    vectors[60] = vectors[59] = [0.0] * 6  # equal vectors under two ids
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] + [0.0] * 5), (103, [float("inf")] + [0.0] * 5),
           (104, [1e30] * 6), (105, []), (106, [1.0] * 5)]
    schema = "vec_id long, embedding array<double>, component string, n string, x string"
    df = spark.createDataFrame([(i, v, "c", "n", "x") for i, v in [*vectors.items(), *bad]], schema).repartition(4)
    checked_whitening(vectors, white(df))
    checked_whitening(vectors, white(df, 2), 2)
    for rows in ([], [(1, [1.0, 2.0], "", "", "")], [(i, [1.0, 2.0], "", "", "") for i in range(4)], [(1, [], "", "", "")]):
        assert white(spark.createDataFrame(rows, schema)) == []
    repeated = white(spark.createDataFrame([(7, [float(i % 2), 1.0], "", "", "") for i in range(4)] + [(None, [0.0, 1.0], "", "", "")], schema))
    assert [r.component for r in repeated] == [1] * 5 and {r.n for r in repeated} == {5}


def test_whitening_of_far_centres_and_large_entries(spark):
    """A mean far from zero, and entries whose products leave the range of doubles and longs, cost no digits."""
    draw = np.random.default_rng(6)
    vectors = {i: (draw.normal(size=4) * (1.0, 2.0, 3.0, 1e6) + (1e9, -1e9, 5e8, 0)).tolist() for i in range(50)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    checked_whitening(vectors, white(df))


def test_factor_keeps_small_eigenvalues():
    """One-sided Jacobi on the factor of a graded matrix finds small eigenvalues to relative precision."""
    draw = np.random.default_rng(7)
    d = np.array([1e3, 30.0, 1.0, 0.03, 1e-3])
    core = np.eye(5) + 0.1 * np.ones((5, 5))
    graded = d[:, None] * core * d[None, :]
    order = draw.permutation(5)
    shuffled = graded[np.ix_(order, order)]
    factor = whitening.pivoted_cholesky(shuffled)
    assert np.abs(factor @ factor.T - shuffled).max() <= 1e-12 * np.abs(shuffled).max()
    values, vectors = whitening.one_sided_jacobi(factor)
    inverse = np.linalg.inv(core)
    largest_of_inverse = np.linalg.eigvalsh(inverse / d[:, None] / d[None, :])[-1]
    assert len(values) == 5
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert values[-1] == pytest.approx(1 / largest_of_inverse, rel=1e-10)
    low = draw.normal(size=(8, 3))
    assert whitening.pivoted_cholesky(low @ low.T).shape == (8, 3)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
