"""Records that can't be read are set apart with their reasons; none is lost, and a repeated run counts once."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from heraldo.sources import quarantine

SCHEMA = StructType().add("id", "long").add("name", "string").add("tags", ArrayType(StringType()))
RULES = {"no tag": lambda r: F.size(r["tags"]) == 0}
CASES = [
    ('{"id": 1, "name": "a", "tags": ["x"]}', []),
    ('{"id": 2, "name": "b"}', []),
    ('{"id": 3, "name": null}', ["missing name"]),
    ('{"id": "four", "name": "d", "tags": []}', ["wrong type", "no tag"]),
    ('{"id": 5, "name": "e", "zone": 1, "more": 2}', ["unknown more", "unknown zone"]),
    ('{"id": 6, "name": "f"', ["not JSON"]),
    ('[{"id": 7, "name": "g"}]', ["not JSON"]),
    ("{}", ["missing id", "missing name"]),
    ("  ", ["empty"]),
    (None, ["empty"]),
    ("null", ["not JSON"]),
]


def test_reasons_and_both_tables(spark, tmp_path):
    raw = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "n int, text string")
    found = quarantine.sorted_records(raw, "text", SCHEMA, ["id", "name"], RULES)
    assert {r.n: r.reasons for r in found.collect()} == {i: why for i, (_, why) in enumerate(CASES)}
    path = str(tmp_path / "records")
    for run in ("one", "two", "two"):
        quarantine.write_sorted(found, path, run)
    read, refused = (quarantine.stored(spark, path, x) for x in (quarantine.READ, quarantine.REFUSED))
    assert sorted((r.run, r.record.id, r.record.name) for r in read.collect()) == [("one", 1, "a"), ("one", 2, "b"), ("two", 1, "a"), ("two", 2, "b")]
    assert refused.count() == 2 * 9
    # read again under a wider schema, a refused record is taken
    again = quarantine.sorted_records(refused.where("run = 'one'").select("n", "text"), "text", StructType.fromDDL("id long, name string, tags array<string>, zone int, more int"), ["id"])
    assert sorted(r.n for r in again.where("size(reasons) = 0").collect()) == [2, 4]


def test_no_records(spark):
    none = spark.createDataFrame([], "n int, text string")
    assert quarantine.sorted_records(none, "text", SCHEMA, ["id"]).collect() == []
