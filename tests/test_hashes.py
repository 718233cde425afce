"""Canonical JSON against Python's own."""

import hashlib
import json

from pyspark.sql import functions as F

from citeloom.operators import files, hashes

SF = "/root/testdata/sf0.001"
TEXTS = ['{"b": 1, "a": {"d": [1.0, 1e10, 1e-7, -0.0, {"z": null, "y": true}], "c": "é\\u00fc🙂\\n\\"/"}}', "[]", '"x"', "{}", '{"a": 12345678901234567890123}', '{"a": 1, "a": 2}', "{broken", "", None, ' {"k" : 3 } ']


def test_canonical_json(spark):
    def want(x):
        try:
            return json.dumps(json.loads(x), sort_keys=True)
        except (TypeError, ValueError):
            return None

    got = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").select("i", hashes.canonical_json(F.col("t")).alias("c")).collect()
    assert {r.i: r.c for r in got} == {i: want(t) for i, t in enumerate(TEXTS)}


def test_hash_of_all_events(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").collect()
    want = {}
    for r in rows:
        event = {"type": r.event_type, "detail": {"props": json.loads(r.props), "by": {"user": r.user_id, "day": r.ts.strftime("%Y-%m-%d")}}, "id": r.event_id}
        want[r.event_id] = hashlib.sha256(json.dumps({"event": event}, sort_keys=True).encode()).hexdigest()
    assert {r.event_id: r.sha for r in hashes.o72(spark, SF).collect()} == want


def test_doubles_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (1e20, 2, "é"), (0.1, 3, None)], "x double, n int, s string")
    got = [r[0] for r in df.select(hashes.document_hash(df)).collect()]
    assert got == [hashlib.sha256(json.dumps(d, sort_keys=True).encode()).hexdigest() for d in ({"x": 1.0, "s": "a"}, {"x": 1e20, "n": 2, "s": "é"}, {"x": 0.1, "n": 3})]


def test_many_small_files(spark, monkeypatch):
    """Arrays and maps in small buckets give the rows of large ones."""
    monkeypatch.setattr(files, "LINES_A_FILE", 40)
    monkeypatch.setattr(files, "CASES_A_MAP", 7)
    assert sorted(r.pos for r in files.s05(spark, SF).collect()) == [0] * 95 + [1] * 95
    assert files.s02(spark, SF).count() == 200 and files.o14(spark, SF).select("webcite").distinct().count() == 1_500
