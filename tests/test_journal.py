"""A task that dies after it has sent: what is sent again, and what lands."""

import os
import subprocess
import sys
from collections import Counter

import pyarrow as pa

from tidemark.sources import fetch, journal

RUN = '''
import os, sys
from tidemark.operators.sinks import Store
from tidemark.session import build_session
from tidemark.sources import fetch, ingest

home = sys.argv[1]

def transport(request):
    with open(home + "/log", "a") as f:
        f.write(f"{request['page_no']}\\n")
    if request["page_no"] in (7, 15) and not os.path.exists(f"{home}/dead{request['page_no']}"):
        open(f"{home}/dead{request['page_no']}", "w").close()
        os._exit(1)
    return fetch.Response(200, '[{"a": %d}]' % request["page_no"])

spark = build_session("journal", "local[2,4]", **{"spark.checkpoint.dir": home + "/shared", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
spark.sparkContext.setLogLevel("OFF")
rows = spark.range(1, 21).selectExpr("'s' AS source", "CAST(id AS INT) AS page_no", "'GET' AS http_method", "'u' AS api_url", "CAST(NULL AS STRING) AS input_value", "CAST(NULL AS STRING) AS request_body")
store = Store(spark, home + "/lake")
with ingest.journal(store, "b") as folder:
    attempts = ingest.land(store, fetch.fetch_pages(rows, transport, in_flight=2, journal=folder, journal_rows=1), "b", "pages")
assert os.listdir(home + "/shared/tidemark-journal") == []
ingest.flush(store, attempts, "b", {"s": "bronze"})
print("PAGES", *sorted(r.Raw_data for r in store.read("bronze").collect()))
print("AUDIT", store.read("audit").count())
spark.stop()
'''


def test_a_task_that_dies_after_sending_lands_each_request_once(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(RUN)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, str(script), str(tmp_path)], env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    lines = {line.split(" ", 1)[0]: line.split(" ", 1)[1] for line in out.stdout.splitlines() if " " in line}
    assert "PAGES" in lines, out.stderr[-2000:]
    assert sorted(lines["PAGES"].replace('{"a": ', "").split(), key=str) == sorted(f"[{i}}}]" for i in range(1, 21))
    assert lines["AUDIT"] == "20"
    sent = Counter((tmp_path / "log").read_text().split())
    assert set(sent) == {str(i) for i in range(1, 21)}
    assert sent["7"] == sent["15"] == 2 and sum(sent.values()) == 22  # only what was under way is sent again


def attempt(page, status="SUCCESS", number=1):
    return {"source": "s", "page_no": page, "attempt_number": number, "status": status, "response_body": "x"}


def test_kept_rows_come_once_and_are_not_asked_again(tmp_path):
    first = journal.Journal(str(tmp_path), 3)
    list(first.kept())
    assert not first.has({"source": "s", "page_no": 1}) and first.has({"source": "s", "page_no": 1})
    for rows in ([attempt(1, "RETRY"), attempt(1, "SUCCESS", 2)], [attempt(2)]):
        first.write(pa.RecordBatch.from_pylist(rows, fetch.ARROW))
    other = journal.Journal(str(tmp_path), 3)  # a speculative run that sent page 2 as well
    other.write(pa.RecordBatch.from_pylist([attempt(2)], fetch.ARROW))
    (tmp_path / "part=3" / "half.tmp").write_bytes(b"cut off")
    again = journal.Journal(str(tmp_path), 3)
    rows = [r for b in again.kept() for r in b.to_pylist()]
    assert sorted((r["page_no"], r["attempt_number"]) for r in rows) == [(1, 1), (1, 2), (2, 1)]
    assert again.has({"source": "s", "page_no": 2}) and not again.has({"source": "s", "page_no": 3})
    assert list(journal.Journal(str(tmp_path), 4).kept()) == []


def test_requests_stay_whole_in_a_batch():
    groups = [[attempt(1, "RETRY"), attempt(1, "SUCCESS", 2)], [attempt(2)], [], [attempt(3)]]
    assert [b.num_rows for b in fetch.record_batches(groups, 2)] == [2, 2]


def test_folders_as_spark_names_them():
    for folder in ("/a/b", "file:/a/b", "file:///a/b"):
        assert journal.located(folder)[1] == "/a/b"
