"""Importance resampling towards a target's distribution over hashed word n-grams.

One scan of each text keeps a ring of running crc32 states, one for each of the last n words as a start; a further word
extends each state by a space and itself and begins a state of its own, and every state is at once the hash of a feature.
The scan stores the buckets of a document's features in a binary column; counts per bucket, gains and weights all come
from that. Counts are summed in each task first, so at most `buckets` rows a task are shuffled, and the table of gains has
one number a bucket, which is all that is collected and broadcast.

Documents are drawn without replacement by the highest sums of weight and Gumbel noise, the noise from a hash of doc_id.
Ranks come from a range sort and the numbers of rows in the partitions before.

Defined cases: null and wordless texts have no feature, weight 0, and are never drawn if a least number of words is asked
for; a null doc_id hashes as the empty string and loses ties; rows of one doc_id are drawn apart from each other, with
the same noise, equal ones in any order; an empty table gives an empty one, an empty target makes rare buckets no better
than common ones by the same formula; a very long text is scanned in one pass, two bytes a feature; columns of other
names are ignored.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import persisted, slices, table
from .kernels import ALNUM

#: A-Z to a-z, and every byte that is no part of a word to a space.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if ALNUM[b] or 65 <= b <= 90 else 32 for b in range(256))


def feature_hashes(words: list[bytes], n: int, buckets: int) -> array:
    """The bucket of each run of 1 to n consecutive words, joined by a space."""
    out, ring = array("I"), []
    for word in words:
        spaced = b" " + word
        ring = [crc32(spaced, state) for state in ring[1 - n :]] if n > 1 else []
        ring.append(crc32(word))
        out.extend([state % buckets for state in ring])
    return out


def bucketed(docs: DataFrame, key: str, n: int, buckets: int) -> DataFrame:
    """(key, n_words, n_features, buckets): the features of each text as little-endian unsigned integers of the width that the number of buckets needs."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts, sizes, found = [], [], []
                for text in part.column("text").cast(pa.large_binary()).to_pylist():
                    words = (text or b"").translate(_FOLD).split()
                    features = feature_hashes(words, n, buckets)
                    counts.append(len(words))
                    sizes.append(len(features))
                    found.append(np.frombuffer(features, np.uint32).astype(kind).tobytes() if len(features) else b"")
                yield pa.record_batch([part.column(0), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], names=["key", "n_words", "n_features", "buckets"])

    kept = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), "text").mapInArrow(run, f"key {kept}, n_words long, n_features long, buckets binary")


def counted(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket: one number a bucket, summed in the tasks and then over them."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for own in batch.column(0):
                total += np.bincount(np.frombuffer(own.as_buffer(), kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "c"])

    out = np.zeros(buckets, np.int64)
    for bucket, c in features.select("buckets").mapInArrow(run, "bucket long, c long").groupBy("bucket").agg(F.sum("c").alias("c")).collect():
        out[bucket] = c
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log of how much likelier a bucket is in the target than in the source, add-one smoothed, floored."""
    size, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_source + size) / ((float(s) + 1) * (all_target + size)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(key, n_words, n_features, weight): weight is the floored mean gain of a document's features, 0 without any."""
    kind, shared = "<u2" if len(gain) <= 1 << 16 else "<u4", features.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for own, size in zip(batch.column("buckets"), batch.column("n_features").to_pylist()):
                weights.append(int(shared.value[np.frombuffer(own.as_buffer(), kind)].sum()) // size if size else 0)
            yield pa.record_batch([batch.column("key"), batch.column("n_words"), batch.column("n_features"), pa.array(weights, pa.int64())], names=["key", "n_words", "n_features", "weight"])

    kept = features.schema["key"].dataType.simpleString()
    return features.mapInArrow(run, f"key {kept}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of sha256(`seed:key`)."""
    first = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((first + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", n: int = 2, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """(key, n_features, weight, score, rank) for every row of docs; rank is null for what isn't drawn.

    Of the rows with `least_words` or more, `percent` in a hundred are drawn, rounded down, by the highest scores.
    """
    spark = docs.sparkSession
    features = persisted(bucketed(docs, key, n, buckets), "features")
    wanted = bucketed(target.select(F.lit(0).alias("key"), "text"), "key", n, buckets)
    gain = gains(counted(features, buckets), counted(wanted, buckets))
    scored = persisted(weighed(features, gain).withColumn("score", F.col("weight") + noise(F.col("key"), seed)), "scored")
    fit = scored.where(F.col("n_words") >= least_words).select("key", "n_features", "weight", "score")
    drawn = percent * fit.count() // 100
    ordered = fit.orderBy(F.desc("score"), F.asc_nulls_last("key"), "weight", "n_features").rdd.zipWithIndex()
    ranked = spark.createDataFrame(ordered.map(lambda x: (*x[0], x[1] + 1 if x[1] < drawn else None)), f"key {fit.schema['key'].dataType.simpleString()}, n_features long, weight long, score long, rank long", verifySchema=False)
    rest = scored.where(F.col("n_words") < least_words).select("key", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest).withColumnRenamed("key", key)


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    return resampled(docs, table(spark, sf_dir, "benchmark"), n=1, buckets=10_000, percent=10, least_words=20, seed=2024)


#: crc32 bit by bit, once for each distinct word.
OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (SELECT doc_id, unnest(ws) AS w FROM d), v AS (SELECT unnest(ws) AS w FROM b),
h AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, strlen(w) + 1), lambda i: list_prepend(
      ((instr('123456789ABCDEF', substr(hex(encode(w)), 2 * i - 1, 1)) * 16 + instr('123456789ABCDEF', substr(hex(encode(w)), 2 * i, 1))))::BIGINT, [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT) % 10000 AS bucket FROM (SELECT w FROM w UNION SELECT w FROM v)),
s AS (SELECT bucket, count(*) AS c FROM w JOIN h USING (w) GROUP BY 1), t AS (SELECT bucket, count(*) AS c FROM v JOIN h USING (w) GROUP BY 1),
g AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.c, 0) + 1)::DOUBLE * ((SELECT sum(c) FROM s) + 10000)::DOUBLE / ((s.c + 1)::DOUBLE * (coalesce((SELECT sum(c) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM w JOIN h USING (w) JOIN g USING (bucket) GROUP BY 1),
n AS (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN m USING (doc_id)),
o AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM n),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit FROM o WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * fit // 100 THEN place END AS rank FROM o LEFT JOIN r USING (doc_id)
"""
