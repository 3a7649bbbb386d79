"""The manifest against a plain recursive tree, over many small partitions and awkward rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from heraldo.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if (v := row[c]) is None else f"{len(str(v).encode())}:{v}" for c in merkle.FIELDS))


def plain_tree(leaves):
    """The root, and each leaf's siblings from the leaf up (None: alone)."""
    level, places, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, at in enumerate(places):
            paths[i].append((at % 2, level[at ^ 1]) if (at ^ 1) < len(level) else None)
            places[i] = at // 2
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([plain_leaf(r) for r in sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))]) for g in order}
    root, upper = plain_tree([trees[g][0] for g in order])
    out = []
    for g, above in zip(order, upper):
        own = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        for r, path in zip(own, trees[g][1]):
            proof = ["-" if s is None else "RL"[s[0]] + s[1] for s in path + above]
            out.append((str(r["doc_id"]), g, plain_leaf(r), trees[g][0], root, proof))
    return sorted(out, key=str)


def built(spark, rows):
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted(((str(r["doc_id"]), r["lang"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in found), key=str)


@pytest.mark.parametrize("partition, span", [(5, 2), (7, 8), (1000, 8)])
def test_trees_over_ragged_partitions(spark, monkeypatch, partition, span):
    monkeypatch.setattr(merkle, "PARTITION_ROWS", partition)
    monkeypatch.setattr(merkle, "SPAN", span)
    sizes = {"de": 61, "en": 1, None: 3, "fr": 16, "é": 2, "zh": 33}
    rows = [{"doc_id": 10_000 * k + i, "text": f"text {i}", "lang": lang, "source": None if i % 3 else "hot", "n_chars": i} for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    assert built(spark, rows) == plain_manifest(rows)


def test_null_repeated_empty_and_long_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PARTITION_ROWS", 4)
    row = lambda **x: dict.fromkeys(merkle.FIELDS) | x
    rows = [row(), row(), row(doc_id=1), row(doc_id=1, text=""), row(doc_id=1, text=""), row(doc_id=2, lang=""), row(doc_id=3, lang="", text="ü" * 500_000, n_chars=2**63 - 1)]
    rows += [row(doc_id=9, text="same", lang="x")] * 20
    assert built(spark, rows) == plain_manifest(rows)
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    clashing = spark.createDataFrame(rows[:3], SCHEMA).selectExpr("*", "1 AS hash", "'x' AS grp", "2 AS root", "3 AS proof", "4 AS level")
    assert clashing.count() == len(merkle.manifest(clashing).collect())


def test_a_changed_leaf_changes_the_folded_root(spark):
    rows = [{"doc_id": i, "text": "t", "lang": "en", "source": "s", "n_chars": None if i == 4 else i} for i in range(9)]
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA))
    both = found.select("doc_id", "root", merkle.folded(F.col("leaf"), F.col("proof")).alias("own"), merkle.folded(F.col("altered"), F.col("proof")).alias("other")).collect()
    assert all(r["own"] == r["root"] for r in both)
    assert [r["doc_id"] for r in both if r["other"] == r["root"]] == [4]
