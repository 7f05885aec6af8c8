"""Files processed by notices: each once, whatever is repeated, late or missing."""

from __future__ import annotations

import json

from conftest import as_tuples

from trendlake import schemas
from trendlake.streaming.notices import MISSING_FILE, ledger_rows, missing_files, new_paths, noticed_reference, run_notices


def category(i, title):
    return {"kind": "category", "id": i, "snippet": {"title": title}}


def test_notices_repeated_encoded_late_and_missing(spark, write, tmp_path):
    silver, progress, told = (f"{tmp_path}/{n}" for n in ("silver", "progress", "told"))
    root = write("region=us/file one+two.json", {"items": [category("1", "one")]})
    write("region=ca/unnoticed.json", {"items": [category("9", "never")]})
    write("region=mx/cut.json", '{"items": [')

    def notice(name, *keys):
        (tmp_path / "told").mkdir(exist_ok=True)
        (tmp_path / "told" / name).write_text("".join(json.dumps({"key": k}) + "\n" for k in keys))
        noticed_reference(spark, told, root, silver, progress)
        table = spark.read.schema(schemas.SILVER_REFERENCE).parquet(silver)
        return as_tuples(table, "region", "id", "snippet_title")

    first = "region%3Dus/file+one%2Btwo.json"
    assert notice("a.json", first, first, "region%3Dgb/later.json", "region%3Dmx/cut.json") == [("us", "1", "one")]
    assert as_tuples(missing_files(spark, progress), "_source_file", "region", "error") == [("region=gb/later.json", "gb", MISSING_FILE)]
    assert notice("b.json", first) == [("us", "1", "one")]
    write("region=gb/later.json", {"items": [category("2", "two")]})
    assert notice("c.json", "region%3Dgb/later.json", first) == [("gb", "2", "two"), ("us", "1", "one")]
    assert missing_files(spark, progress).collect() == []
    errors = spark.read.parquet(f"{silver}_errors")
    assert as_tuples(errors, "region") == [("mx",)]


def test_files_come_in_bounded_parts_and_again_after_a_failure(spark, write, tmp_path):
    progress, told = f"{tmp_path}/progress", tmp_path / "told"
    for i in range(5):
        root = write(f"region=us/{i}.json", {"items": []})
    told.mkdir()
    (told / "a.json").write_text("".join(json.dumps({"key": f"region=us/{i}.json"}) + "\n" for i in range(5)))
    parts, broken = [], []

    def handle(paths, name):
        if len(parts) == 1 and not broken:
            broken.append(name)
            raise OSError("lost")
        parts.append((name, len(paths)))

    try:
        run_notices(spark, str(told), root, progress, handle, max_files=2)
    except Exception as error:  # noqa: BLE001
        assert "lost" in str(error)
    run_notices(spark, str(told), root, progress, handle, max_files=2)
    assert parts == [("0-0", 2), ("0-0", 2), ("0-1", 2), ("0-2", 1)]
    run_notices(spark, str(told), root, progress, handle, max_files=2)
    assert len(parts) == 4 and ledger_rows(spark, f"{progress}/ledger").count() == 5


def test_new_paths(spark):
    notices = spark.createDataFrame([("/a%20b",), ("a+b",), ("c",), ("",), (None,), ("d",)], "key string")
    ledger = spark.createDataFrame([("c", True), ("d", False)], "path string, found boolean")
    assert as_tuples(new_paths(notices, ledger), "path") == [("a b",), ("d",)]
