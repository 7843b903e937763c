"""Merkle manifests against plain trees."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from farebox.llm import merkle, queries

SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_record(*values):
    texts = [None if v is None else str(v) for v in values]
    return sha("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def plain_tree(leaves):
    """The root, and for each leaf its levels: (siblings before, siblings after)."""
    paths = [[] for _ in leaves]
    nodes, owners = list(leaves), [[n] for n in range(len(leaves))]
    while len(nodes) > 1:
        above, heirs = [], []
        for lo in range(0, len(nodes), 16):
            run = nodes[lo : lo + 16]
            for place in range(len(run)):
                for leaf in owners[lo + place]:
                    paths[leaf].append((run[:place], run[place + 1 :]))
            above.append(sha("".join(run)))
            heirs.append([leaf for owner in owners[lo : lo + 16] for leaf in owner])
        nodes, owners = above, heirs
    return nodes[0], paths


def plain_manifest(rows):
    """(id, leaf, subroot, root, proof, folded, verified) of (id, source, leaf, claim)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[name] = plain_tree([r[2] for r in groups[name]])
    root, above = plain_tree([trees[name][0] for name in names])
    found = []
    for name, up in zip(names, above, strict=True):
        for row, path in zip(groups[name], trees[name][1], strict=True):
            whole = path + up
            fold = row[3]
            for left, right in whole:
                fold = sha("".join([*left, fold, *right]))
            proof = sha("".join(d for left, right in whole for d in left + right))
            found.append((row[0], row[2], trees[name][0], root, proof, fold, fold == root))
    return found


def columns(df, first="id"):
    names = [first, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_growing_tree_at_every_size():
    leaves = [hashlib.sha256(bytes([n % 7, n // 7])).digest() for n in range(300)]
    for size in [*range(1, 40), 255, 256, 257, 271, 272, 273, 300]:
        tree = merkle.Growing()
        members = [tree.append(leaf) for leaf in leaves[:size]]
        root = tree.finish(merkle.height(size))
        expected, paths = plain_tree([leaf.hex() for leaf in leaves[:size]])
        assert root.hex() == expected
        for leaf, member, path in zip(leaves, members, paths, strict=False):
            witness = tree.witness(member)
            assert merkle.folded(leaf, witness) == root
            assert [s.hex() for _, s in merkle.steps(witness)] == [
                "".join(left + right) for left, right in path
            ]


def test_witnesses_grow_with_each_completed_run():
    tree = merkle.Growing()
    first = tree.append(b"a" * 32)
    for n in range(1, 256):
        assert len(list(merkle.steps(tree.witness(first)))) == (n >= 16)
        tree.append(bytes([n]) * 32)
    assert len(list(merkle.steps(tree.witness(first)))) == 2


def test_query(spark, documents):
    rows = []
    for r in documents.collect():
        leaf = plain_record(r.doc_id, r.source, r.lang, r.n_chars, r.text)
        claim = leaf
        if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
            claim = plain_record(r.doc_id, r.source, r.lang, r.n_chars, low)
        rows.append((r.doc_id, r.source, leaf, claim))
    result = queries.QUERIES["op11_merkle_witnesses"](spark, SF_DIR)
    assert columns(result, "doc_id") == sorted(plain_manifest(rows), key=str)


@pytest.fixture(scope="module")
def many(spark):
    """Sources of sizes around the powers of 16, one without a name, and 300 single rows."""
    sizes = {"a": 1, "b": 16, "c": 17, "é": 256, "z": 257, None: 4_100, "": 3}
    values = [(n, name, "en", n, f"Text {n}") for name, size in sizes.items() for n in range(size)]
    values += [(n, f"single {n}", None, None, None) for n in range(300)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    return spark.createDataFrame(values, schema).repartition(7)


def leaves_of(df):
    return [(r.doc_id, r.source, *[plain_record(*[r[c] for c in merkle.FIELDS])] * 2) for r in df.collect()]


def proved(made):
    return columns(merkle.verified(made.trees().proofs()))


def test_many_sources_and_blocks(many):
    found = proved(merkle.manifest(many))
    assert found == sorted(plain_manifest(leaves_of(many)), key=str)
    assert all(row[-1] for row in found)


def test_appends_give_the_manifest_of_the_whole(many):
    parts = [
        many.filter("doc_id < 5"),
        many.filter("doc_id >= 5 and doc_id < 260"),
        many.filter("doc_id >= 260"),
    ]
    grown = merkle.manifest(parts[0])
    for part in parts[1:]:
        before = grown.appends
        grown = grown.append(merkle.records(part))
        assert grown.appends[:-1] == before
    assert proved(grown) == sorted(plain_manifest(leaves_of(many)), key=str)


def test_append_of_earlier_ids_fails(many):
    made = merkle.manifest(many.filter("doc_id >= 5"))
    with pytest.raises(Exception, match="do not come last"):
        made.append(merkle.records(many.filter("doc_id < 5 and source = 'z'"))).pieces().count()


def test_roots(many):
    found = {(r.source, r.root.hex()) for r in merkle.manifest(many).trees().roots().collect()}
    assert found == {(row[1], plain[2]) for row, plain in _by_source(many)}


def _by_source(df):
    rows = leaves_of(df)
    subroots = {}
    for row in rows:
        subroots.setdefault(row[1], []).append(row)
    return [
        (group[0], plain_manifest(group)[0][:2] + (plain_manifest(group)[0][2],))
        for group in subroots.values()
    ]


def test_odd_rows(odd):
    found = proved(merkle.manifest(odd))
    assert found == sorted(plain_manifest(leaves_of(odd)), key=str)
    assert len(found) == odd.count()


def test_copies_of_one_row_span_blocks(spark):
    rows = spark.range(1_000).select(
        F.lit(1).cast("long").alias("doc_id"),
        F.lit("s").alias("source"),
        F.lit("en").alias("lang"),
        F.lit(4).cast("long").alias("n_chars"),
        F.lit("same").alias("text"),
    )
    assert proved(merkle.manifest(rows)) == sorted(plain_manifest(leaves_of(rows)), key=str)


def test_empty_table(empty):
    made = merkle.manifest(empty)
    assert proved(made) == [] and made.trees().roots().count() == 0


def test_a_changed_record_is_found(many):
    claimed = F.when(F.col("doc_id") == 9, F.sha2(F.lit("other"), 256)).otherwise(
        merkle.record_digest([F.col(c) for c in merkle.FIELDS])
    )
    found = merkle.verified(merkle.manifest(many, claimed).trees().proofs())
    assert {r.id for r in found.filter("not verified").collect()} == {9}
    assert found.filter("id = 9 and verified").count() == 0
