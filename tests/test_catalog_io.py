"""Catalog DDL (C1-C8), file/table IO (S1-S9, K1-K6, K11) and small operators."""

import json
from datetime import time as dtime

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import catalog as CAT
from tidemark.operators import clean as C
from tidemark.operators.incremental import high_watermark, table_or_none
from tidemark.schemas import RAW_MACRO
from tidemark.sinks.files import append_if_any, insert_rows, save_table, write_csv, write_parquet
from tidemark.sinks.jdbc import jdbc_options
from tidemark.sources.files import read_csv, read_extract, read_parquet
from tidemark.sources.rows import from_pandas, from_rows


def test_people_filter_job(spark):
    """People of age >= 30."""
    df = from_rows(spark, [("Alice", 30), ("Bob", 25), ("Carol", 40), ("David", 22)], ["nome", "idade"])
    assert sorted(r.nome for r in df.filter(F.col("idade") >= 30).collect()) == ["Alice", "Carol"]
    assert dict(df.dtypes)["idade"] == "bigint"


def test_declared_schema_rejects_null_key(spark):
    schema = T.StructType([T.StructField("ticker", T.StringType(), False), T.StructField("v", T.DoubleType())])
    assert from_rows(spark, [("A", 1.0)], schema).count() == 1
    try:
        from_rows(spark, [(None, 1.0)], schema).collect()
        raise AssertionError("null key accepted")
    except Exception as e:
        assert "null" in str(e).lower() or "NULLABLE" in str(e)


def test_csv_roundtrip_is_all_text(spark, tmp):
    df = from_rows(spark, [(1, "Produto A", 9.99), (2, "Produto B", 19.99), (3, "Produto C", 29.99)],
                   ["id", "nome", "preco"])
    write_csv(df, f"{tmp}/csv")
    back = read_csv(spark, f"{tmp}/csv")
    assert set(t for _, t in back.dtypes) == {"string"}
    write_parquet(back, f"{tmp}/pq")
    assert sorted(r.preco for r in read_parquet(spark, f"{tmp}/pq").collect()) == ["19.99", "29.99", "9.99"]


def test_pandas_source(spark):
    pdf = pd.DataFrame({"data": pd.to_datetime(["2025-01-02"]).date, "valor": [1.5]})
    assert from_pandas(spark, pdf).first().valor == 1.5


def test_catalog_ddl(spark, tmp):
    dbs = CAT.ensure_database(spark, "spark_db")
    assert "spark_db" in dbs
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("descricao", T.StringType())])
    CAT.ensure_external(spark, "spark_db.tabela_externa", schema, f"{tmp}/ext")
    spark.sql("INSERT INTO spark_db.tabela_externa VALUES (100, 'Registro Externo A'), (101, 'Registro Externo B')")
    assert spark.table("spark_db.tabela_externa").count() == 2
    assert "tabela_externa" in CAT.list_tables(spark, "spark_db")
    assert CAT.describe(spark, "spark_db.tabela_externa").count() > 2
    CAT.drop_table(spark, "spark_db.tabela_externa")
    assert spark.read.parquet(f"{tmp}/ext").count() == 2        # external: files survive the drop
    CAT.register(spark, "spark_db.registrada", f"{tmp}/ext")
    assert spark.table("spark_db.registrada").count() == 2
    CAT.comment_columns(spark, "spark_db.registrada", {"descricao": "Descrição do registro"})
    desc = {r.col_name: r.comment for r in spark.sql("DESCRIBE spark_db.registrada").collect()}
    assert desc["descricao"] == "Descrição do registro"
    CAT.create_view(spark.table("spark_db.registrada"), "v_registrada")
    assert spark.sql("SELECT count(*) AS n FROM v_registrada").first().n == 2


def test_bootstrap_raw_is_idempotent(spark, tmp):
    assert CAT.bootstrap_raw(spark, tmp, db="raw_t") == ["cdi", "cotacao_moedas", "cotacoes_indices", "igpm", "ipca"]
    CAT.bootstrap_raw(spark, tmp, db="raw_t")
    got = [(f.name, f.dataType) for f in spark.table("raw_t.cdi").schema.fields]
    assert got == [(f.name, f.dataType) for f in RAW_MACRO.fields]


def test_managed_table_insert_and_count(spark):
    """L4: an extract with time-of-day columns -> text -> managed table -> count."""
    df = from_rows(spark, [(1, "08:30:00")], "id long, hora string")
    assert C.stringify_time(df).dtypes == df.dtypes
    save_table(df, "tabela_sas", bucket_by=(4, ["id"]))
    insert_rows(from_rows(spark, [("09:00:00", 2)], "hora string, id long").select("id", "hora"), "tabela_sas")
    assert spark.table("tabela_sas").count() == 2


def test_append_if_any(spark, tmp):
    calls = []
    assert append_if_any(spark.range(0), lambda d: calls.append(1)) is False
    assert append_if_any(spark.range(3), lambda d: d.write.mode("append").parquet(f"{tmp}/a")) is True
    assert calls == [] and spark.read.parquet(f"{tmp}/a").count() == 3


def test_jdbc_url():
    from tidemark.sinks.jdbc import jdbc_url
    assert jdbc_url("db", 5432, "sgs", "raw") == "jdbc:postgresql://db:5432/sgs?currentSchema=raw"
    assert jdbc_url("db", 5432, "sgs") == "jdbc:postgresql://db:5432/sgs"


def test_jdbc_options_take_credentials_as_arguments():
    o = jdbc_options("jdbc:postgresql://h:5432/db", "cdi", user="u", password="p", schema="raw",
                     num_partitions=4, batch_size=1000)
    assert o["dbtable"] == "raw.cdi" and o["numPartitions"] == "4" and o["batchsize"] == "1000"


def test_high_watermark_missing_and_empty(spark, tmp):
    assert high_watermark(table_or_none(spark, f"{tmp}/nope"), "d") is None
    empty = spark.createDataFrame([], "d date")
    assert high_watermark(empty, "d") is None


def test_read_extract_one_scan(spark, tmp):
    for t in ("VT", "^GSPC"):
        with open(f"{tmp}/{t.strip('^')}.json", "w") as fh:
            fh.write(json.dumps({"symbol": t, "Date": "2025-01-02T00:00:00", "Close": 10.5, "Volume": 7}) + "\n")
    df = read_extract(spark, "history", tmp)
    assert sorted(r.symbol for r in df.collect()) == ["VT", "^GSPC"]
    assert dict(df.dtypes)["Close"] == "double"


def test_first_present_and_quarantine(spark):
    df = from_rows(spark, [("1", 5.0)], "x string, Close double")
    assert C.first_present(df, ["Adj Close", "Close"], "adj").first().adj == 5.0
    good, bad = C.convert_or_quarantine(from_rows(spark, [("1",), ("x",), (None,)], "v string"), {"v": "bigint"})
    assert sorted((r.v for r in good.collect()), key=str) == [1, None]
    assert [(r.v, r.bad_columns) for r in bad.collect()] == [("x", "v")]


def test_stringify_time_walks_schema(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        df = spark.createDataFrame([(1,)], "id long").withColumn("h", F.lit("08:00:00").cast("time"))
        out = C.stringify_time(df)
        assert dict(out.dtypes)["h"] == "string" and out.first().h == "08:00:00"
    finally:
        spark.conf.set("spark.sql.timeType.enabled", "false")


def test_sas_extract_to_table(spark):
    """L4: a decoded extract with time-of-day values -> text -> managed table -> count."""
    pdf = pd.DataFrame({"id": [1, 2], "hora": [dtime(8, 30), dtime(9, 0)], "v": [1.0, 2.0]})
    sdf = from_pandas(spark, C.stringify_time(pdf))
    save_table(sdf, "extrato_sas")
    assert spark.table("extrato_sas").count() == 2
    assert sorted(r.hora for r in spark.table("extrato_sas").collect()) == ["08:30:00", "09:00:00"]


def test_cleanse_sentinel_keeps_null(spark):
    df = from_rows(spark, [("Infinity",), ("-Infinity",), (None,), ("2.5",)], "beta string")
    got = [r.beta for r in C.cleanse_sentinel(df, {"beta": 0.0}, {"beta": "double"}).collect()]
    assert got == [0.0, 0.0, None, 2.5]


def test_cluster_conf_sizes_partitions():
    from tidemark.session import cluster_conf
    c = cluster_conf(100 << 40, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert cluster_conf(1 << 20, 10, 4)["spark.sql.shuffle.partitions"] == "80"
