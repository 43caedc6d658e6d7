"""Registered queries over small tables, against plain Python."""

import datetime

import __spark_entry__


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_html_text_reads_whole_documents(spark, tmp_path):
    long = "casa  com\tquintal " * 400
    data = [(1, "olx", long), (2, "olx", "a < b & c\n\n d" + "x" * 80), (3, None, "sem fonte"), (4, "lopes", None), (5, None, None), (6, "olx", "")]
    spark.createDataFrame(data, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = [(i, source, len(" ".join(f"{source or ''} {(text or '').replace('<', ' ')} {i}".split()))) for i, source, text in data]
    assert rows(__spark_entry__.queries()["html_text"](spark, str(tmp_path))) == sorted(want, key=repr)


def test_upsert_takes_every_row(spark, tmp_path):
    at = datetime.datetime
    data = [(7, "olx", "sale", "early", 1.0, at(2025, 9, 1)), (2, "olx", "sale", "both", 2.0, at(2026, 1, 9)), (3, "olx", "sale", "both", 3.0, at(2026, 2, 1)), (4, "olx", "rent", "late", 4.0, at(2028, 2, 1)), (5, None, "", "undated", 5.0, None), (6, "", None, "undated", 6.0, at(2025, 12, 1))]
    spark.createDataFrame(data, "row_id bigint, source string, business_type string, property_id string, price double, last_seen_at timestamp_ntz").write.parquet(f"{tmp_path}/listings_unificados.parquet")
    queries = __spark_entry__.queries()
    got = {r.property_id: (r.row_id, r.first_seen, r.last_seen) for r in queries["upsert_history"](spark, str(tmp_path)).collect()}
    assert got == {"early": (7, "2026-01-01", "2026-02-01"), "both": (3, "2026-01-01", "2026-04-01"), "late": (4, "2026-04-01", "2026-04-01"), "undated": (6, "2026-01-01", "2026-02-01")}
    assert rows(queries["upsert_counts"](spark, str(tmp_path))) == [(1, 2)]


def test_delta_takes_every_event(spark, tmp_path):
    at = datetime.datetime
    data = [(10, "view", at(2024, 1, 24)), (10, "view", at(2024, 1, 29)), (20, "view", at(2024, 1, 24)), (3, "click", at(2024, 1, 30)), (4, "view", at(2024, 1, 2))]
    spark.createDataFrame(data, "user_id bigint, event_type string, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    queries = __spark_entry__.queries()
    assert rows(queries["incremental_delta"](spark, str(tmp_path)).select("url", "change")) == [("10|view", "updated"), ("20|view", "unchanged"), ("3|click", "new"), ("4|view", "filtered")]
    assert rows(queries["delta_counts"](spark, str(tmp_path))) == [(1, 1, 1, 1)]
    assert rows(queries["delta_sort"](spark, str(tmp_path)).select("place", "url")) == [(1, "3|click"), (2, "10|view")]
