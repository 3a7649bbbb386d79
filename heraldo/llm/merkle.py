"""A Merkle manifest of a document table: a tree per language, a tree over the languages' roots, a proof per document.

Leaves are range-sorted by (group, doc_id) into an RDD whose partitions stay as they are over all jobs. A first job counts
the rows of the groups at each partition's two edges; these few numbers a partition are all that the driver sees, and tell
each partition where in its first group it starts and how long its last one gets. Each partition then builds all subtrees
that are complete in it, and emits the few nodes whose parent isn't (ragged nodes, two a level and edge at most). These are
shuffled by coordinate, the ancestor SPAN levels further up, which gives at most a few hundred nodes a group of any size;
so many rounds as the height takes finish the upper levels. Proofs join back from the top.

Hashes are lowercase hex sha256 of the children's hex digests. A proof is one entry for each level from the leaf to the
root: `L<digest>` or `R<digest>`, the sibling and its side, or `-` where a node is alone and is hashed alone.

Defined cases: null fields hash as `-`, so a null text differs from an empty one; a null language is a group, before all
others; null doc_ids come first in their group; rows of one doc_id follow each other by their leaves, equal rows in any
order, and each keeps a place and a proof of its own; an empty table gives an empty manifest; a long text is hashed whole
where it stands and never shuffled; columns of other names are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import persisted, table

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PARTITION_ROWS, SPAN = 20_000, 8


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(**columns: Column) -> Column:
    """The hash of a row's fields in order, each with its length; columns replace fields."""
    of = lambda c: F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c), F.lit(":"), c))
    return F.sha2(F.concat(*[of(columns.get(name, F.col(name)).cast("string")) for name in FIELDS]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    step = lambda h, x: F.when(x.startswith("L"), F.concat(F.substring(x, 2, 64), h)).when(x.startswith("R"), F.concat(h, F.substring(x, 2, 64))).otherwise(h)
    return F.aggregate(proof, leaf, lambda h, x: F.sha2(step(h, x), 256))


def proof_hash(proof: Column) -> Column:
    """The hash of a proof's siblings, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.substring(x, 2, 64)), ""), 256)


def _grow(start: int, hashes: list[str], total: int) -> tuple[list[tuple[int, list[str], int]], list[tuple[int, int, str]]]:
    """Levels (first index, hashes, width of the whole level) over consecutive leaves, as far as nodes are complete here;
    and the nodes (level, index, hash) that have no parent here."""
    levels, tops, lo, nodes, width = [], [], start, hashes, total
    while nodes:
        levels.append((lo, nodes, width))
        hi, level = lo + len(nodes), len(levels) - 1
        if width == 1:
            tops.append((level, 0, nodes[0]))
            break
        if lo % 2:
            tops.append((level, lo, nodes[0]))
        if hi % 2 and hi < width:
            tops.append((level, hi - 1, nodes[-1]))
        first, last = (lo + 1) // 2, hi // 2 if hi < width else (width + 1) // 2
        nodes = [digest(nodes[2 * i - lo] + (nodes[2 * i + 1 - lo] if 2 * i + 1 < width else "")) for i in range(first, last)]
        lo, width = first, (width + 1) // 2
    return levels, tops


def _sibling(index: int, lo: int, nodes: list[str], width: int) -> str:
    other = index ^ 1
    return "-," if other >= width else f"{'L' if other < index else 'R'}{nodes[other - lo]},"


def _paths(levels: list[tuple[int, list[str], int]]) -> list[tuple[str, int, int]]:
    """Of each leaf the proof within the levels, and the (level, index) of the node where it ends."""
    above: list[tuple[str, int, int]] = []
    for level in range(len(levels) - 1, -1, -1):
        lo, nodes, width = levels[level]
        up = levels[level + 1][0] if level + 1 < len(levels) else 0
        here = []
        for index in range(lo, lo + len(nodes)):
            at = index // 2 - up
            if 0 <= at < len(above):
                proof, top, place = above[at]
                here.append((_sibling(index, lo, nodes, width) + proof, top, place))
            else:
                here.append(("", level, index))
        above = here
    return above


def _edges(index: int, rows: Iterator) -> Iterator[tuple]:
    first = last = None
    single = True
    for group, own in groupby(rows, itemgetter(0)):
        last = (group, sum(1 for _ in own))
        first, single = first or last, first is None
    if first:
        yield index, first, last, single


def _offsets(edges: list[tuple]) -> tuple[dict[int, tuple[int, int]], int]:
    """For each partition the rows of its first group before it and of its last group after it; and the most rows of a
    group that crosses partitions."""
    ahead, most = {}, 0
    held: tuple | None = None
    for index, first, last, single in edges:
        ahead[index] = held[1] if held and held[0] == first[0] else 0
        held = (last[0], last[1] + (ahead[index] if single else 0))
    after: dict[int, int] = {}
    held = None
    for index, first, last, single in reversed(edges):
        after[index] = held[1] if held and held[0] == last[0] else 0
        held = (first[0], first[1] + (after[index] if single else 0))
    for index, first, last, single in edges:
        if ahead[index] or after[index]:
            most = max(most, ahead[index] + first[1], last[1] + after[index] + (ahead[index] if single else 0))
    return {i: (ahead[i], after[i]) for i in ahead}, most


def _runs(index: int, rows: Iterator, offsets: dict[int, tuple[int, int]]) -> Iterator[tuple]:
    """(group, its rows here, index of the first, rows of the whole group) of one partition."""
    ahead, after = offsets.get(index, (0, 0))
    first, held = True, None
    for group, own in groupby(rows, itemgetter(0)):
        if held:
            yield (*held, held[2] + len(held[1]))
        held = (group, list(own), ahead if first else 0)
        first = False
    if held:
        yield (*held, held[2] + len(held[1]) + after)


def _height(total: Column) -> Column:
    return F.ceil(F.log2(total.cast("double"))).cast("int")


_FINISHED = "grp string, level int, idx long, total long, proof string, up_level int, up_idx long, up_hash string"


def _finish(nodes: pd.DataFrame) -> pd.DataFrame:
    """The nodes under one coordinate, which tile it, built up to it."""
    target, total = int(nodes["target"].iloc[0]), int(nodes["total"].iloc[0])
    known: dict[int, dict[int, str]] = {}
    for level, idx, own in zip(nodes["level"], nodes["idx"], nodes["hash"]):
        known.setdefault(int(level), {})[int(idx)] = own
    width = lambda level: (total + (1 << level) - 1) >> level
    for level in range(min(known), target):
        for idx, own in list(known.get(level, {}).items()):
            if not idx % 2:
                other = known[level][idx + 1] if idx + 1 < width(level) else ""
                known.setdefault(level + 1, {})[idx // 2] = digest(own + other)
    proofs = []
    for level, idx in zip(nodes["level"], nodes["idx"]):
        proof = ""
        for at in range(int(level), target):
            place = int(idx) >> (at - int(level))
            other = place ^ 1
            proof += "-," if other >= width(at) else f"{'L' if other < place else 'R'}{known[at][other]},"
        proofs.append(proof)
    ((top, root),) = known[target].items()
    return pd.DataFrame({"grp": nodes["grp"], "level": nodes["level"], "idx": nodes["idx"], "total": nodes["total"], "proof": proofs, "up_level": target, "up_idx": top, "up_hash": root})


def trees(leaves: DataFrame, order: list[str]) -> DataFrame:
    """One tree for each `grp` over the stored leaves' `hash` by `order`: leaves with root and proof (as one string).

    leaves must be a stored table, and order must tell apart rows with different hashes.
    """
    spark = leaves.sparkSession
    extra = [c for c in leaves.columns if c not in ("grp", "hash")]
    n = max(1, -(-leaves.count() // PARTITION_ROWS))
    ordered = leaves.repartitionByRange(n, "grp", *order).sortWithinPartitions("grp", *order).select("grp", "hash", *extra).rdd.map(tuple)
    offsets, most = _offsets(sorted(ordered.mapPartitionsWithIndex(_edges).collect(), key=itemgetter(0)))
    shared = spark.sparkContext.broadcast(offsets)  # two numbers a partition

    def ragged(index: int, rows: Iterator) -> Iterator[tuple]:
        for group, own, start, total in _runs(index, rows, shared.value):
            for level, idx, top in _grow(start, [r[1] for r in own], total)[1]:
                yield group, level, idx, total, top

    def proven(index: int, rows: Iterator) -> Iterator[tuple]:
        for group, own, start, total in _runs(index, rows, shared.value):
            levels, _ = _grow(start, [r[1] for r in own], total)
            for r, (proof, level, idx) in zip(own, _paths(levels)):
                yield (*r, proof, level, idx)

    frame = lambda f, schema: spark.createDataFrame(ordered.mapPartitionsWithIndex(f), schema, verifySchema=False)
    nodes = persisted(frame(ragged, "grp string, level int, idx long, total long, hash string"), "ragged")
    tall = _height(F.col("total"))
    roots = nodes.where(F.col("level") == tall).select("grp", "level", "idx", F.col("hash").alias("root"), F.lit("").alias("above"))
    active, rounds = nodes.where(F.col("level") < tall), []
    for top in range(SPAN, max(most - 1, 0).bit_length() + SPAN, SPAN):
        target = F.least(F.lit(top), tall)
        low = active.where(F.col("level") < top).withColumn("target", target).withColumn("spot", F.expr("shiftright(idx, target - level)"))
        done = persisted(low.groupBy("grp", "target", "spot").applyInPandas(_finish, _FINISHED), "levels")
        rounds.append(done)
        up = done.select("grp", F.col("up_level").alias("level"), F.col("up_idx").alias("idx"), "total", F.col("up_hash").alias("hash")).distinct()
        roots = roots.unionByName(up.where(F.col("level") == tall).select("grp", "level", "idx", F.col("hash").alias("root"), F.lit("").alias("above")))
        active = active.where(F.col("level") >= top).unionByName(up.where(F.col("level") < tall))
    full = roots
    for done in reversed(rounds):
        upper = full.select(F.col("grp").alias("upper"), F.col("level").alias("up_level"), F.col("idx").alias("up_idx"), "root", "above")
        through = done.join(upper, F.col("grp").eqNullSafe(F.col("upper")) & (done["up_level"] == upper["up_level"]) & (done["up_idx"] == upper["up_idx"]))
        full = full.unionByName(through.select("grp", "level", "idx", "root", F.concat("proof", "above").alias("above")))
    full = persisted(full.select(F.col("grp").alias("upper"), "level", "idx", "root", "above"), "upper")
    types = {f.name: f.dataType for f in leaves.schema}
    schema = ", ".join(f"`{c}` {types[c].simpleString()}" for c in ("grp", "hash", *extra))
    local = frame(proven, f"{schema}, proof string, top_level int, top_idx long")
    joined = local.join(full, F.col("grp").eqNullSafe(F.col("upper")) & (F.col("top_level") == F.col("level")) & (F.col("top_idx") == F.col("idx")))
    return joined.select("grp", "hash", *extra, "root", F.concat("proof", "above").alias("proof"))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, altered, subroot, root, proof) for every row; proof leads from leaf by subroot to root.

    altered is the leaf of the row as `n_chars` + 1 makes it, for checks of tampering.
    """
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    one = docs.select(*FIELDS)
    # equal rows may change places, so a number of their own keeps many of them from falling into one range
    leaves = persisted(one.select(F.col("lang").alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), leaf_hash().alias("hash"), leaf_hash(n_chars=more).alias("altered"), F.monotonically_increasing_id().alias("row")), "leaves")
    within = trees(leaves, ["doc_id", "hash", "row"])
    within = persisted(within.drop("row"), "proven")
    subroots = persisted(within.select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("lang"), F.col("root").alias("hash")).distinct(), "subroots")
    over = trees(subroots, ["lang"]).select(F.col("lang").alias("over"), F.col("root").alias("top"), F.col("proof").alias("rest"))
    out = within.join(over, F.col("grp").eqNullSafe(F.col("over")))
    proof = F.filter(F.split(F.concat("proof", "rest"), ","), lambda x: x != "")
    return out.select("doc_id", F.col("grp").alias("lang"), F.col("hash").alias("leaf"), "altered", F.col("root").alias("subroot"), F.col("top").alias("root"), proof.alias("proof"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    found = manifest(table(spark, sf_dir, "documents"))
    out = found.withColumn("folded_root", folded(F.when(tampered, F.col("altered")).otherwise(F.col("leaf")), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: Levels by recursion; crc32 bit by bit over the decimal doc_id.
OP11_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, lang,
    CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(doc_id::VARCHAR), ':', doc_id) END || CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END
      || CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END AS tail, n_chars,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: list_prepend(ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT) AS crc FROM documents),
e AS (SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END || tail) AS leaf,
    sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen((n_chars + 1)::VARCHAR), ':', n_chars + 1) END || tail) AS altered, crc FROM d),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM e),
t AS (SELECT lang, 0 AS level, pos AS idx, leaf AS h, n FROM l UNION ALL
      SELECT lang, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 1) // 2) FROM t WHERE n > 1 GROUP BY lang, level, idx // 2),
s AS (SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS level, pos AS idx, subroot AS h, n FROM s UNION ALL
      SELECT level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 1) // 2) FROM u WHERE n > 1 GROUP BY level, idx // 2),
nodes AS (SELECT lang, level, idx, h FROM t WHERE n > 1 UNION ALL SELECT s.lang, u.level + s.height, u.idx, u.h FROM u, s WHERE u.n > 1),
places AS (SELECT l.lang, l.pos, g.level, l.pos >> g.level AS idx FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang, LATERAL (SELECT unnest(range(s.height)) AS level) g UNION ALL
      SELECT l.lang, l.pos, s.height + g.level, s.pos >> g.level FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang, LATERAL (SELECT unnest(range((SELECT max(level) FROM u))) AS level) g),
path AS (SELECT p.lang, p.pos, p.level, p.idx, o.h FROM places p LEFT JOIN nodes o ON o.lang IS NOT DISTINCT FROM p.lang AND o.level = p.level AND o.idx = xor(p.idx, 1)),
proofs AS (SELECT lang, pos, sha256(coalesce(string_agg(h, '' ORDER BY level), '')) AS proof_sha256 FROM path GROUP BY lang, pos),
f AS (SELECT lang, pos, 0 AS level, CASE WHEN crc % 7 = 0 THEN altered ELSE leaf END AS h FROM l UNION ALL
      SELECT f.lang, f.pos, f.level + 1, sha256(CASE WHEN p.h IS NULL THEN f.h WHEN p.idx % 2 = 1 THEN p.h || f.h ELSE f.h || p.h END)
      FROM f JOIN path p ON p.lang IS NOT DISTINCT FROM f.lang AND p.pos = f.pos AND p.level = f.level),
r AS (SELECT lang, pos, arg_max(h, level) AS folded_root FROM f GROUP BY lang, pos),
top AS (SELECT h AS root FROM u WHERE n = 1)
SELECT l.doc_id, l.leaf, s.subroot, top.root, coalesce(proofs.proof_sha256, sha256('')) AS proof_sha256, r.folded_root, r.folded_root = top.root AS verified
FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN r ON r.lang IS NOT DISTINCT FROM l.lang AND r.pos = l.pos
LEFT JOIN proofs ON proofs.lang IS NOT DISTINCT FROM l.lang AND proofs.pos = l.pos, top
"""
