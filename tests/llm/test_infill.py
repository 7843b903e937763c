"""The rank index and infill rows against plain forms."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farebox.llm import infill, queries

SF_DIR = "/root/testdata/sf0.001"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text, seed=42, rate=50, spm_rate=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    name = "" if doc_id is None else doc_id
    h = [int(sha(f"{seed}:{name}")[n : n + 8], 16) for n in (0, 8, 16, 24)]
    first, second = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = ("".join(t) for t in (tokens[:first], tokens[first:second], tokens[second:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (doc_id, len(tokens), "plain", None, None, text)
    if h[3] % 100 < spm_rate:
        return (doc_id, len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def plain_boundaries(text):
    places, at = [0], 0
    for token in TOKEN.findall(text):
        at += len(token.encode())
        places.append(at)
    return places


def index_of(texts):
    return infill.boundaries(*infill._texts(pa.array(texts, pa.string())))


texts = st.lists(st.text(alphabet="abé\U0001f600 \t\n\r <PSM>", max_size=60), max_size=8)


@settings(deadline=None, max_examples=200)
@given(texts)
def test_boundaries_are_the_tokens(values):
    places, starts = index_of(values)
    found = [places[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert found == [plain_boundaries(text) for text in values]


def test_boundaries_over_many_scans(monkeypatch):
    monkeypatch.setattr(infill, "SCANNED", 7)
    values = ["one  two\tthree ", "", " ", "x", "  é é\n", "four five six seven eight  "] * 3
    places, starts = index_of(values)
    found = [places[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert found == [plain_boundaries(text) for text in values]


def test_index_is_exact_and_bounded():
    rng = np.random.default_rng(5)
    sizes = np.where(rng.random(20_000) < 0.001, 300, rng.integers(1, 9, 20_000))
    words = ["x" * int(n) for n in sizes]
    values = [" ".join(words), "", "a b c", " ".join(words[:50]), "y" * 5_000]
    places, starts = index_of(values)
    index = infill.RankIndex.fitted(places, starts)
    assert (index.places(np.arange(len(places))) == places).all()
    assert np.abs(index.residuals.astype(int)).max() <= infill.ERROR
    # One line serves many boundaries, and no line crosses from text to text.
    assert len(index.firsts) < len(places) / 20
    assert set(starts[:-1]) <= set(index.firsts)
    again = infill.RankIndex.loaded(index.stored())
    assert (again.places(np.arange(len(places))) == places).all()
    assert (again.starts == index.starts).all() and (again.lines == index.lines).all()


def test_regular_text_needs_one_line():
    places, starts = index_of(["word " * 10_000])
    assert len(infill.RankIndex.fitted(places, starts).firsts) == 1


def rows(df):
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_query(spark, documents):
    expected = {}
    for r in documents.select("doc_id", "text").collect():
        *head, output = plain(r.doc_id, r.text)
        expected[r.doc_id] = (*head[1:], sha(output), sha(r.text or ""))
    result = queries.QUERIES["op13_infill_rank_index"](spark, SF_DIR)
    names = ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert {r.doc_id: tuple(r[n] for n in names) for r in result.collect()} == expected
    assert {row[1] for row in expected.values()} == {"plain", "spm", "psm"}


def test_other_rates_and_a_stored_index(spark, documents, tmp_path):
    docs = documents.select("doc_id", "text")
    infill.with_index(docs, "places").write.parquet(str(tmp_path / "indexed"))
    indexed = spark.read.parquet(str(tmp_path / "indexed"))
    for seed in (7, 8):
        cut = infill.transformed(indexed, seed, 90, 30, index_column="places")
        assert rows(cut) == sorted(
            (plain(r.doc_id, r.text, seed, 90, 30) for r in docs.collect()), key=str
        )


def test_odd_rows(odd):
    found = infill.transformed(odd, rate=100)
    assert rows(found) == sorted(
        (plain(r.doc_id, r.text, rate=100) for r in odd.collect()), key=str
    )


def test_restored(spark):
    values = [
        (1, "a <b> c"), (2, "<<"), (3, "x <P> y"), (4, "S> <S M> <"), (5, "é\U0001f600 <\n  z "),
        (6, "one"), (7, " "), (8, ""), (9, "<S <P <M < < <"),
    ]
    docs = spark.createDataFrame(values, "doc_id long, text string")
    for seed in range(6):
        for spm_rate in (0, 100):
            cut = infill.transformed(docs, seed, 100, spm_rate)
            back = cut.select("id", infill.restored(F.col("output"), F.col("form")).alias("text"))
            assert sorted(tuple(r) for r in back.collect()) == values


def test_empty_table(empty):
    assert rows(infill.transformed(empty)) == []
    assert infill.with_index(empty.select("doc_id", "text"), "i").count() == 0
