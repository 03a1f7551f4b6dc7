"""The manifest's trees, log and proofs against plain Python."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from hostpulse.llm.merkle import (
    document_manifest,
    fold,
    height,
    position,
    write_manifest,
    written_before,
)

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def joined(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels(digests):
    found = [digests]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([joined(*last[at : at + 3]) for at in range(0, len(last), 3)])
    return found


def postorder(tree, level, place):
    if level:
        below = range(3 * place, min(3 * place + 3, len(tree[level - 1])))
        for child in below:
            yield from postorder(tree, level - 1, child)
    yield level, place


def siblings(tree, place):
    for level in tree[:-1]:
        start = place // 3 * 3
        yield level[start:place], level[place + 1 : start + 3]
        place //= 3


@pytest.mark.parametrize("size", [*range(1, 100), 242, 243, 244, 729, 730])
def test_positions_are_the_order_of_completion(size):
    tree = levels([str(leaf) for leaf in range(size)])
    assert height(size) == len(tree) - 1
    order = list(postorder(tree, len(tree) - 1, 0))
    assert [position(level, place, size) for level, place in order] == list(range(len(order)))
    assert written_before(1) == 1 and written_before(3) == 4 and written_before(9) == 13


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc_id, source, lang, n_chars, _ = row
    return joined(*map(field, (doc_id, source, lang, n_chars, text)))


def order(value):
    return (value is not None, value if value is not None else 0)


def manifest_of(rows):
    sources = sorted({row[1] for row in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, tops, found = {}, [], []
    for source in sources:
        mine = [(order(row[0]), leaf(row, row[4]), row) for row in rows if row[1] == source]
        mine.sort(key=lambda x: x[:2])
        trees[source] = (levels([digest for _, digest, _ in mine]), [row for *_, row in mine])
        tops.append(trees[source][0][-1][0])
    over = levels(tops)
    for number, source in enumerate(sources):
        tree, mine = trees[source]
        for place, row in enumerate(mine):
            path = [*siblings(tree, place), *siblings(over, number)]
            doc_id, text = row[0], row[4]
            changed = tree[0][place]
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                changed = leaf(row, text and text.replace("\n", ""))
            for left, right in path:
                changed = joined(*left, changed, *right)
            root = over[-1][0]
            steps = [("".join(left), "".join(right)) for left, right in path]
            found.append((doc_id, tree[0][place], tops[number], root, steps, changed, changed == root))
    return found


def collected(frame):
    rows = [
        (*row[:4], [tuple(step) for step in row.path], row.folded_root, row.verified)
        for row in frame.select("doc_id", "leaf", "subroot", "root", "path", "folded_root", "verified").collect()
    ]
    return sorted(rows, key=repr)


ODD = [
    (None, None, None, None, None),
    (None, "a", "en", 3, "no id\n"),
    (3, None, "en", 1, ""),
    (4, "a", None, None, None),
    (4, "a", "en", 2, "x\ny"),
    (4, "a", "en", 2, "x\ny"),
    (-7, "é", "en", 4, "\n\n"),
    (9, "", "en", 6, "long " * 50_000),
    (10, "Z", "", 0, "lone"),
]


def test_against_brute_force(spark):
    rows = [*ODD]
    rows += [(doc, "hot", "en", doc, f"text {doc}\nline") for doc in range(2300)]
    rows += [(doc, f"s{doc % 40}", "fr", None, f"text\n{doc}") for doc in range(5000, 5300)]
    frame = spark.createDataFrame(rows, DOCS).repartition(7)
    # Columns of the names that the operator uses itself change nothing.
    frame = frame.withColumns({name: F.lit(1) for name in ("tree", "key", "place", "path", "root", "copy")})
    assert collected(document_manifest(frame)) == sorted(manifest_of(rows), key=repr)


def test_small_tables(spark):
    assert document_manifest(spark.createDataFrame([], DOCS)).count() == 0
    for row in (ODD[0], ODD[8]):
        found = document_manifest(spark.createDataFrame([row], DOCS)).first()
        assert found.leaf == found.subroot == found.root == found.folded_root and found.verified
        assert found.path == []
    assert collected(document_manifest(spark.createDataFrame(ODD, DOCS))) == sorted(manifest_of(ODD), key=repr)


def test_log_is_each_tree_in_postorder(spark):
    rows = [(("hot", "b", None)[doc % 11 // 5], doc, joined(str(doc))) for doc in range(3000)]
    leaves = spark.createDataFrame(rows, "tree string, key bigint, digest string")
    manifest = write_manifest(leaves.withColumn("other", F.lit(None).cast("string")))
    log = manifest.log.orderBy("tree", "position").collect()
    tops = []
    for name in (None, "b", "hot"):
        tree = levels([digest for source, _, digest in rows if source == name])
        mine = [row for row in log if row.tree == name]
        assert [row.position for row in mine] == list(range(len(mine)))
        expected = [tree[level][place] for level, place in postorder(tree, len(tree) - 1, 0)]
        assert [row.digest for row in mine] == expected
        assert [row.digest for row in mine if row.root] == [tree[-1][0]]
        tops.append(tree[-1][0])
    assert manifest.root == levels(tops)[-1][0]
    assert [row.digest for row in manifest.root_log.orderBy("position").collect()][:3] == tops
    proved = manifest.proofs().withColumn("back", fold("path", F.col("digest")))
    assert proved.count() == 3000 and proved.where(F.col("back") != manifest.root).count() == 0


def test_only_real_changes_are_noticed(spark):
    rows = [(doc, "s", "en", 1, "a\nb" if doc % 2 else "ab") for doc in range(200)]
    found = document_manifest(spark.createDataFrame(rows, DOCS)).collect()
    for row in found:
        tampered = zlib.crc32(str(row.doc_id).encode()) % 2 == 0
        assert row.verified == (not (tampered and row.doc_id % 2))
