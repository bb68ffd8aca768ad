import json

import pytest

from tests.conftest import at, rows
from tillstream.__main__ import main
from tillstream.sources.readers import read_days, register_tables
from tillstream.sources.schemas import AGG_SCHEMA, FACT_SCHEMA


def message(id, time, **fields):
    body = {
        "transaction_id": id, "store_id": "store_1", "product_id": "product_1", "quantity": 2, "price": 2.5,
        "payment_type": "cash", "transaction_ts": f"2024-01-01T{time}Z",
    } | fields
    return (bytearray(b"\x00\x00\x00\x00\x01" + json.dumps(body).encode()),)


@pytest.mark.parametrize("upsert", [[], ["--upsert-agg"]])
def test_stream_fact_and_checks(spark, tmp_path, capsys, upsert):
    root = str(tmp_path)
    stream = [
        "stream", "--source", "parquet", "--path", f"{root}/in", "--payload", "json", "--raw", f"{root}/raw", "--agg",
        f"{root}/agg", "--rejects", f"{root}/rejects", "--checkpoint", f"{root}/cp", "--trigger", "available-now", *upsert,
    ]
    fact = ["fact", "--raw", f"{root}/raw", "--fact", f"{root}/fact", "--lookback", "1 hour"]

    def arrive(*messages):
        spark.createDataFrame(list(messages), "value binary").write.mode("append").parquet(f"{root}/in")
        assert main(stream) == 0 and main(fact) == 0

    arrive(message("a", "00:00:00"), message("a", "00:00:00"), message("b", "00:30:00"), (bytearray(b"x"),))
    arrive(message("b", "00:30:00"), message("c", "00:31:00"), message("d", "00:32:00", store_id=None))
    fact_rows = rows(read_days(spark, f"{root}/fact", FACT_SCHEMA), "transaction_id", "revenue")
    assert fact_rows == [("a", 5.0), ("b", 5.0), ("c", 5.0)]
    assert rows(read_days(spark, f"{root}/agg", AGG_SCHEMA), "store_id", "total_revenue") == [("store_1", 5.0)]
    assert spark.read.schema("reject_reason string").parquet(f"{root}/rejects").count() == 2
    for missing in ("--path", "--checkpoint"):
        at_option = stream.index(missing)
        with pytest.raises(SystemExit):
            main(stream[:at_option] + stream[at_option + 2 :])

    checks = ["checks", "--raw", f"{root}/raw", "--as-of", "2024-01-01 00:40:00", "--fail"]
    assert main(checks) == 0
    assert capsys.readouterr().out.splitlines() == ["freshness: PASS 2", "PASS"]
    assert main([*checks, "--fact", f"{root}/fact", "--agg", f"{root}/agg"]) == 0
    told = capsys.readouterr().out.splitlines()
    assert "transaction_id unique 0 PASS" in told and "window_start not_null 0 PASS" in told

    register_tables(spark, raw=f"{root}/raw", agg=f"{root}/agg", fact=f"{root}/fact")
    status = spark.sql(
        "SELECT count(*), max(transaction_ts) FROM raw_retail_sales UNION ALL "
        "SELECT count(*), max(window_start) FROM agg_store_sales_5min UNION ALL "
        "SELECT count(*), max(transaction_ts) FROM fact_sales"
    )
    assert [tuple(r) for r in status.collect()] == [(3, at("00:31")), (1, at("00:00")), (3, at("00:31"))]
