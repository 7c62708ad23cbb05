"""Queries that must look at whole texts and all rows."""

import re

from millrace import queries as Q
from millrace.functions.redact import PATTERNS

SUFFIX = {0: " Password= abc", 1: " Bearer a-b.c==", 2: " basic abc=", 3: " api_key:xyz z"}


def test_redacts_past_any_prefix(spark, tmp_path):
    rows = [(5, "x " * 300 + "password=hunter2 end"), (6, "y " * 5000 + "token: abc"), (9, "short"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.safe for r in Q.queries()["redact_values"](spark, str(tmp_path)).collect()}
    for k, text in rows:
        want = None if text is None else text + SUFFIX.get(k % 5, "")
        for p in PATTERNS if want else ():
            want = re.sub(p, "[REDACTED]", want, flags=re.ASCII)
        assert got[k] == want
    assert "hunter2" not in got[5] and "abc" not in got[6]


def test_rotates_all_events(spark):
    sf = "/root/testdata/sf0.01"
    ids = [r.event_id for r in spark.read.parquet(f"{sf}/events.parquet").select("event_id").collect()]
    sizes = [sum(i % 16 == k for i in ids) for k in range(16)]
    got = Q.queries()["rotation_file_count"](spark, sf).first()
    assert got.rows == len(ids) and got.files == sum(-(-n // 500) for n in sizes) > 16
