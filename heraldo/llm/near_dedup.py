"""MinHash near-duplicate detection with HyperMinHash registers.

Each document's set of word shingles is reduced to REGISTERS compressed registers: a shingle's 64-bit hash picks a bucket
by its top bits, and the bucket keeps the least remaining hash as leading-zero count plus MANTISSA leading bits (16 bits
in all). Empty registers borrow from full ones along a fixed probing order, so that any two sets agree in a register
with probability about J. Bands of registers give candidate pairs; the collision-corrected Jaccard estimate drops those
clearly below the threshold; what remains is confirmed on the full shingle sets.

Work in groups stays linear. Equal sets are one class from the start, represented by one row. In a band's
bucket of up to SMALL classes all pairs are candidates (at most SMALL per class and band). In a larger bucket every class
is paired with the bucket's centre, the class that meets most others over all bands (for edited copies, the original).
Exact way for the rest: classes of large buckets which are then outside the component of their centre go through a prefix
join with all classes of that centre (see _rest), which loses no pair that reaches the threshold.

Defined cases: null or wordless text has an empty set, is linked with nothing and keeps itself; a text with fewer words
than a shingle is one shingle; each row has a number of its own and is judged by its own text, so rows of one doc_id, or of
none, are linked like any others; a group's doc_ids come before its rows without one, and a group of such rows alone has no
component_id but keeps its first row; an empty table gives an empty one; a very long text is one slice, its shingles held by
one task; columns of any other name pass through filter_documents and are ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import persisted, slices, table
from .components import components
from .kernels import NON_SPACE, U64, gram_hashes, mix, words_of

REGISTERS, MANTISSA, ROWS = 256, 10, 6
BANDS = REGISTERS // ROWS
SMALL = 12
#: Standard deviations below the threshold at which an estimate rules a pair out.
SLACK = 5.0
_EMPTY = 65535
_rng = np.random.default_rng(7)
_PROBES = _rng.integers(0, REGISTERS, (48, REGISTERS))
_BAND_SALT = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.int64).astype(U64) | U64(1)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text index, shingle hash) of a column of texts."""
    words = words_of(column, NON_SPACE, lower=True)
    counts = np.diff(words.first)
    hashes, at = gram_hashes(words, size)
    docs = words.docs[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = [mix(np.bitwise_xor.reduce(mix(words.hashes[words.first[d] : words.first[d + 1]] + np.arange(counts[d]).astype(U64) * U64(0x632BE59BD9B4E019)), keepdims=True) + U64(counts[d]))[0] for d in short]
        docs, hashes = np.concatenate([docs, short]), np.concatenate([hashes, np.array(extra, U64)])
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    fresh = np.ones(len(docs), bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    return docs[fresh], hashes[fresh]


def registers(docs: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """HyperMinHash registers of n sets, as n x REGISTERS of uint16: the exponent counts leading zeros, the rest is mantissa."""
    out = np.full((n, REGISTERS), _EMPTY, np.uint16)
    h = mix(hashes)
    bucket = (h >> U64(56)).astype(np.int64)
    rest = (h << U64(8)).astype(np.float64).view(U64) >> U64(52 - MANTISSA)
    code = np.maximum(rest.astype(np.int64) - (1023 << MANTISSA), 0)
    np.minimum.at(out.reshape(-1), docs * REGISTERS + bucket, np.minimum(code, _EMPTY - 1).astype(np.uint16))
    full = out != _EMPTY
    for row in np.flatnonzero(full.any(1) & ~full.all(1)):
        own, has = out[row].copy(), full[row]
        todo = np.flatnonzero(~has)
        for probe in _PROBES:
            hit = has[probe[todo]]
            out[row, todo[hit]] = own[probe[todo[hit]]]
            todo = todo[~hit]
            if not len(todo):
                break
        if len(todo):  # very small sets: the next full register, in circular order
            filled = np.flatnonzero(has)
            out[row, todo] = own[filled[np.searchsorted(filled, todo) % len(filled)]]
    return out


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                docs, hashes = shingle_sets(part.column("text"), size)
                counts = np.bincount(docs, minlength=n)
                first = np.searchsorted(docs, np.arange(n))
                one, two = (np.zeros(n, U64) for _ in range(2))
                if len(docs):
                    some = counts > 0
                    one[some] = np.add.reduceat(mix(hashes + U64(1)), first[some])
                    two[some] = np.add.reduceat(mix(hashes ^ U64(0xA5A5A5A5A5A5A5A5)), first[some])
                regs = registers(docs, hashes, n)
                yield pa.record_batch(
                    [part.column("row"), part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array([r.tobytes() if c else b"" for r, c in zip(regs, counts)], pa.binary())],
                    names=["row", "doc_id", "n_shingles", "s1", "s2", "regs"],
                )

    return run


def sketches(rows: DataFrame, size: int) -> DataFrame:
    """(row, doc_id, n_shingles, s1, s2, regs): set size, 128 bits that identify the set, and its registers."""
    return rows.mapInArrow(_sketch(size), "row long, doc_id long, n_shingles long, s1 long, s2 long, regs binary")


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.stack([np.frombuffer(x, np.uint16) for x in batch.column("regs").to_pylist()])[:, : BANDS * ROWS]
        keys = mix((mix(regs.reshape(-1, BANDS, ROWS).astype(U64) + U64(1)) * _BAND_SALT).sum(2, dtype=U64) + np.arange(BANDS).astype(U64))
        ids = np.repeat(batch.column("rep").to_numpy(), BANDS)
        yield pa.record_batch([pa.array(keys.reshape(-1).view(np.int64)), pa.array(ids)], names=["band", "rep"])


def estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard of register rows: the share of equal registers, corrected for different minima with equal registers."""
    equal = (ra == rb).mean(1)
    scale = np.exp2(np.arange(65) - 64.0)
    chance = np.zeros(len(na))
    la, lb = na[:, None] / REGISTERS, nb[:, None] / REGISTERS
    inside = np.diff(-np.expm1(-la * scale), axis=1) * np.diff(-np.expm1(-lb * scale), axis=1)
    chance = inside.sum(1) / (1 << MANTISSA)
    return np.clip((equal - chance) / (1 - chance), 0, 1)


def _likely(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            ra, rb = (np.stack([np.frombuffer(x, np.uint16) for x in batch.column(c).to_pylist()]) for c in ("ra", "rb"))
            full = REGISTERS * -np.expm1(-np.maximum(na, nb) / REGISTERS)
            keep = estimate(ra, rb, na, nb) >= threshold - SLACK * np.sqrt(threshold * (1 - threshold) / np.maximum(full, 1))
            yield pa.record_batch([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    return run


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = pa.record_batch([batch.column("a"), batch.column("b"), batch.column("text_a"), batch.column("text_b")], names=["a", "b", "text", "text_b"])
            for part in slices(both, limit=1 << 20):
                keep = []
                da, ha = shingle_sets(part.column("text"), size)
                db, hb = shingle_sets(part.column("text_b"), size)
                ia, ib = (np.searchsorted(d, np.arange(part.num_rows + 1)) for d in (da, db))
                for i in range(part.num_rows):
                    x, y = ha[ia[i] : ia[i + 1]], hb[ib[i] : ib[i + 1]]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
                mask = pa.array(keep, pa.bool_())
                yield pa.record_batch([part.column("a").filter(mask), part.column("b").filter(mask)], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The candidate pairs (a, b) whose full shingle sets reach the threshold."""
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    likely = persisted(sized.mapInArrow(_likely(percent / 100), "a long, b long"), "likely")
    text = lambda x: texts.select(F.col("row").alias(x), F.col("text").alias(f"text_{x}"))
    return persisted(likely.join(text("a"), "a").join(text("b"), "b").mapInArrow(_confirm(size, percent), "a long, b long"), "links")


def _strays(size: int, percent: int):
    """Of each (centre, rep) row the shingles that the centre lacks, and of its others as many as fill the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = pa.record_batch([batch.column(c) for c in ("centre", "rep", "own", "outside", "text_rep", "text_centre")], names=["centre", "rep", "own", "outside", "text", "text_centre"])
            for part in slices(both, limit=1 << 20):
                docs, hashes = shingle_sets(part.column("text"), size)
                of_centre, known = shingle_sets(part.column("text_centre"), size)
                ends, centre_ends = (np.searchsorted(d, np.arange(part.num_rows + 1)) for d in (docs, of_centre))
                row, n, shared, token = [], [], [], []
                for i in range(part.num_rows):
                    own = hashes[ends[i] : ends[i + 1]]
                    common = np.isin(own, known[centre_ends[i] : centre_ends[i + 1]], assume_unique=True)
                    strange = own[~common]
                    fill = own[common][: max(0, _prefix(len(own), percent) - len(strange))]
                    row += [i] * (len(strange) + len(fill))
                    n += [len(own)] * (len(strange) + len(fill))
                    shared += [False] * len(strange) + [True] * len(fill)
                    token += [strange, fill]
                kept = part.select(["centre", "rep", "own", "outside"]).take(pa.array(row, pa.int64()))
                tokens = np.concatenate(token).view(np.int64) if token else np.zeros(0, np.int64)
                yield pa.record_batch([*kept.columns, pa.array(n, pa.int32()), pa.array(shared, pa.bool_()), pa.array(tokens)], names=["centre", "rep", "own", "outside", "n", "shared", "token"])

    return run


def _prefix(n: int, percent: int) -> int:
    """How many of n shingles, in any order, hold one that a set shares which reaches the threshold."""
    return n - -(-percent * n // 100) + 1


def _rest(placed: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of one centre's classes, one of them outside the centre's component, that may reach the threshold.

    An exact prefix join: in any one order of shingles, the first one that two sets share stands so early in both that
    the rest of either set can still hold the overlap that the threshold asks for. The order puts what the centre lacks
    first, and of that what fewest of the group's classes hold, so that a passage which many of them share pairs none.
    """
    open_groups = placed.where("outside").select("centre").distinct()
    text = lambda x: texts.select(F.col("row").alias(x), F.col("text").alias(f"text_{x}"))
    rows = placed.join(open_groups, "centre", "left_semi").join(text("rep"), "rep").join(text("centre"), "centre")
    tokens = persisted(rows.mapInArrow(_strays(size, percent), "centre long, rep long, own long, outside boolean, n int, shared boolean, token long"), "strays")
    common = tokens.where("not shared").groupBy("centre", "token").agg(F.count("*").alias("held"))
    order = Window.partitionBy("centre", "rep").orderBy("shared", "held", "token")  # one document's shingles
    placed_tokens = tokens.join(common, ["centre", "token"], "left").withColumn("pos", F.row_number().over(order) - 1)
    tokens = persisted(placed_tokens.where(F.expr(f"pos <= n - ceil({percent} * n / 100)")).drop("held", "shared"), "prefixes")
    x, y = tokens.where("outside").alias("x"), tokens.alias("y")
    fits = F.expr(f"x.centre = y.centre and x.token = y.token and x.own <> y.own and {100 + percent} * least(x.n - x.pos, y.n - y.pos) >= {percent} * (x.n + y.n)")
    return x.join(y, fits).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc): each row as a struct beside a number of its own, stored so that the numbers stay."""
    return persisted(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "rows")


def near_duplicates(rows: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept) for every row of a numbered() table.

    Rows are linked whose sets of `shingle`-word shingles have 100 * intersection >= percent * union; component_id is the
    smallest doc_id reachable over links, itself included; kept is true for the first row of a group, by doc_id and row.
    """
    one = rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").alias("text"))
    sketch = persisted(sketches(one, shingle), "sketch")
    known = sketch.select("row", "doc_id", "n_shingles", "s1", "s2")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    classes = persisted(known.where("n_shingles > 0").groupBy("s1", "s2", "n_shingles").agg(F.min("row").alias("rep"), first), "classes")
    reps = persisted(classes.select("rep", F.col("n_shingles").alias("n")).join(sketch.select(F.col("row").alias("rep"), "regs"), "rep"), "reps")
    bands = reps.select("rep", "regs").mapInArrow(_bands, "band long, rep long")
    counts = bands.groupBy("band").agg(F.count("*").alias("c")).where("c > 1")
    members = persisted(bands.join(counts, "band"), "members")
    degree = members.groupBy("rep").agg(F.sum("c").alias("degree"))
    centres = members.where(F.col("c") > SMALL).join(degree, "rep").groupBy("band").agg(F.max_by("rep", F.struct("degree", -F.col("rep"))).alias("centre"))
    centres = persisted(centres, "centres")
    small = members.where(F.col("c") <= SMALL).select("band", "rep")
    pairs = small.select("band", F.col("rep").alias("a")).join(small.select("band", F.col("rep").alias("b")), "band").where("a < b").select("a", "b")
    large = members.where(F.col("c") > SMALL).select("band", "rep")
    star = large.join(centres, "band").where("rep <> centre").select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
    tried = persisted(pairs.union(star).distinct(), "pairs")
    links = confirmed(tried, reps, one, shingle, percent)
    found = components(links)

    placed = large.join(centres, "band").where("rep <> centre").select("centre", "rep").distinct()
    placed = placed.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("centre", "rep", F.coalesce("component", "rep").alias("own"))
    middle = found.select(F.col("node").alias("centre"), F.col("component").alias("main"))
    placed = persisted(placed.join(middle, "centre", "left").select("centre", "rep", "own", (F.col("own") != F.coalesce("main", "centre")).alias("outside")), "placed")
    if placed.where("outside").limit(1).count():
        rest = _rest(placed, one, shingle, percent).join(tried, ["a", "b"], "left_anti")
        more = confirmed(rest, reps, one, shingle, percent)
        if more.limit(1).count():
            found = components(links.unionByName(more))

    of_class = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("s1", "s2", "n_shingles", "first", F.coalesce("component", "rep").alias("component"))
    firsts = of_class.groupBy("component").agg(F.min("first").alias("first"))
    of_class = of_class.drop("first").join(firsts, "component").select("s1", "s2", "n_shingles", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first_row"))
    out = known.where("n_shingles > 0").join(of_class, ["s1", "s2", "n_shingles"]).select("row", "doc_id", "n_shingles", "component_id", (F.col("row") == F.col("first_row")).alias("kept"))
    return out.unionByName(known.where("n_shingles = 0").select("row", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")))


def filter_documents(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row, the first by doc_id, of each group of near-duplicates."""
    rows = numbered(docs)
    return rows.join(near_duplicates(rows, shingle, percent).where("kept").select("row"), "row", "left_semi").select("doc.*")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(numbered(table(spark, sf_dir, "documents").select("doc_id", "text")), shingle=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("kept")).alias("kept"))


#: The contract in SQL: all pairs that share a shingle, then reachability.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(list_slice(ws, i, i + 3), ' ')) END) AS g FROM w),
e AS (SELECT doc_id, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN s sa ON sa.doc_id = p.a JOIN s sb ON sb.doc_id = p.b WHERE 100 * c >= 80 * (len(sa.g) + len(sb.g) - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM s UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
m AS (SELECT node, min(root) AS component_id FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept FROM s JOIN m ON m.node = s.doc_id
"""
