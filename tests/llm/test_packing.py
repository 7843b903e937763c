"""Packing against plain best fit, and sequences against the tokenizer."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from farebox.llm import packing, queries

SF_DIR = "/root/testdata/sf0.001"


def plain_best_fit(lengths, capacities, rule):
    limits = (capacities.tokens, capacities.documents, capacities.cost)
    bins, out = [], []
    for length in lengths:
        asked = (length, 1, length**2)
        best = None
        for number, free in enumerate(bins):
            if all(f >= a for f, a in zip(free, asked, strict=True)):
                score = 0.0
                for f, a, top, weight in zip(free, asked, limits, capacities.weights, strict=True):
                    if rule == "norm":
                        score += weight * (f / top - a / top) ** 2
                    else:
                        score += weight * (a / top) * (f / top)
                if best is None or score < best[0]:
                    best = (score, number)
        if best is None:
            bins.append(list(limits))
            best = (0, len(bins) - 1)
        free = bins[best[1]]
        out.append((best[1], capacities.tokens - free[0]))
        for d in range(3):
            free[d] -= asked[d]
    return out


@settings(deadline=None, max_examples=60)
@given(
    st.lists(st.integers(1, 64), max_size=80),
    st.integers(1, 9),
    st.integers(64**2, 3 * 64**2),
    st.sampled_from(["norm", "dot"]),
)
def test_best_fit_is_the_plain_one(lengths, documents, cost, rule):
    capacities = packing.Capacities(64, documents, cost, (1.0, 0.5, 0.25))
    lengths = sorted(lengths, reverse=True)
    chosen, places = packing.best_fit(np.array(lengths, np.int64), capacities, rule)
    assert list(zip(chosen.tolist(), places.tolist(), strict=True)) == plain_best_fit(
        lengths, capacities, rule
    )


def pieces_of(spark, lengths):
    values = [(n, n, 0, 0, length, bytes(2 * length)) for n, length in enumerate(lengths)]
    return spark.createDataFrame(
        values, "row long, doc_id long, piece int, start long, length long, ids binary"
    ).repartition(5)


def placements(sequences, lengths):
    """Per sequence its (offset, length); every piece is in one."""
    found = {r.sequence_id: [(p.offset, p.length) for p in r.parts] for r in sequences}
    assert len(found) == len(sequences)
    ids = sorted(p.doc_id for r in sequences for p in r.parts)
    assert ids == list(range(len(lengths)))
    assert all(p.length == lengths[p.doc_id] for r in sequences for p in r.parts)
    for parts in found.values():
        at = 0
        for offset, length in parts:
            assert offset == at
            at += length
    return found


def test_every_capacity_holds(spark):
    random.seed(3)
    lengths = [random.choice([1, 2, 3, 30, 31, 50]) for _ in range(3_000)]
    capacities = packing.Capacities(64, 12, 3_000)
    for rule in ("norm", "dot"):
        packed = packing.packed(pieces_of(spark, lengths), 3, capacities, rule)
        for parts in placements(packed.collect(), lengths).values():
            assert len(parts) <= 12 and sum(n * n for _, n in parts) <= 3_000
            assert sum(n for _, n in parts) <= 64


def test_rounds_pack_loose_sequences_again(spark, monkeypatch):
    random.seed(4)
    lengths = [random.randint(1, 60) for _ in range(2_000)]
    pieces, capacities = pieces_of(spark, lengths), packing.Capacities(64, 64, 4096)
    whole = packing.packed(pieces, 1, capacities).count()
    once = packing.packed(pieces, 30, capacities).collect()
    monkeypatch.setattr(packing, "ROUNDS", 1)
    single = packing.packed(pieces, 30, capacities).count()
    assert whole <= len(placements(once, lengths)) <= single
    assert len(once) <= 1.03 * whole


def plain_ids(text):
    coder = plain_ids.__dict__.setdefault(
        "coder", Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    )
    return [*coder.encode(text or "", add_special_tokens=False).ids, 1]


def checked(found, texts):
    """The pieces of one packing, against the tokenizer; the number of sequences."""
    expected = collections.Counter()
    for doc_id, text in texts:
        ids = plain_ids(text)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            expected[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in found) == expected
    held = collections.defaultdict(list)
    for r in found:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(held)


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_query(spark, documents):
    found = queries.QUERIES["op12_vector_packing"](spark, SF_DIR).select(*NAMES).collect()
    used = checked(found, documents.select("doc_id", "text").collect())
    assert used == -(-sum(r.length for r in found) // 4096)


def sequences(df, **options):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.sequences(df, path, **options).collect()


def test_odd_rows(odd):
    texts = collections.Counter((r.doc_id, tuple(plain_ids(r.text))) for r in odd.collect())
    documents = collections.defaultdict(dict)
    for sequence in sequences(odd):
        ids = np.frombuffer(sequence.ids, "<u4")
        assert sum(p.length for p in sequence.parts) == len(ids) <= 4096
        for p in sequence.parts:
            part = ids[p.offset : p.offset + p.length].tolist()
            documents[p.doc_id].setdefault(p.piece, []).append((p.start, part))
    long = documents.pop(5)
    whole = [token for piece in sorted(long) for token in long[piece][0][1]]
    assert [long[n][0][0] for n in sorted(long)] == list(range(0, len(whole), 4096))
    assert texts.pop((5, tuple(whole))) == 1
    assert texts == collections.Counter(
        (doc_id, tuple(part)) for doc_id, found in documents.items() for _, part in found[0]
    )


def test_tight_capacities(odd):
    found = sequences(odd, capacities=packing.Capacities(100, 2, 6_400))
    for sequence in found:
        lengths = [p.length for p in sequence.parts]
        assert len(lengths) <= 2 and sum(n * n for n in lengths) <= 6_400 and max(lengths) <= 80


def test_empty_table(empty):
    assert sequences(empty) == []


def test_unknown_rule_is_an_error():
    with pytest.raises(ValueError, match="rule"):
        packing.best_fit(np.array([1]), packing.Capacities(), "worst")
