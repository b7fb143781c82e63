import io
import math
import zipfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from volcast.sinks.files import write_csv
from volcast.sources import archives as ar
from volcast.sources import encode as enc
from volcast.sources import klines as kl
from volcast.sources import messages as msg
from volcast.sources.tables import table


def test_kline_json_strings_numbers_and_garbage(spark):
    rows = [
        ('{"e":"kline","E":1,"s":"BTC","k":{"t":0,"T":60000,"s":"BTC","i":"1m","o":"1.5","c":"2.5","h":"3",'
         '"l":"1","v":"10","V":"4","n":7,"x":true}}',),
        ('{"e":"kline","E":1,"s":"ETH","k":{"t":0,"T":120000,"s":"ETH","i":"1m","o":1.5,"c":2.25,"h":3,'
         '"l":1,"v":10,"V":4,"n":7,"x":true}}',),
        ('{"e":"kline","E":1,"s":"ETH","k":{"t":0,"T":180000,"s":"ETH","i":"1m","o":1,"c":"abc","h":3,'
         '"l":1,"v":10,"V":4,"n":7,"x":false}}',),
        ('{"e":"kline", broken',),
    ]
    df = spark.createDataFrame(rows, "value string")
    d = msg.decode_kline(df).orderBy("event_time").collect()
    assert d[0]._bad is True  # the broken record (null time sorts first)
    good = [r for r in d if not r._bad]
    assert [(r.symbol, r.close, r.volume, r.taker_buy_volume) for r in good] == [
        ("BTC", 2.5, 10.0, 4.0), ("ETH", 2.25, 10.0, 4.0)]      # a close that is no number makes the event bad
    closed = msg.closed_candles(msg.decode_kline(df))
    assert closed.count() == 2


def test_envelope_routing_counts(spark):
    ev = table(spark, SF_SMALL, "events")
    c = msg.reject_counts(enc.envelopes(ev)).first()
    assert c.n_messages == ev.count()
    assert c.n_bad_envelope + c.n_open + c.n_routed + c.n_bad_event == c.n_messages
    r = msg.route(enc.envelopes(ev))
    assert r.count() == c.n_routed
    # forwarded value is the untouched inner JSON
    v = r.select(F.col("value").cast("string").alias("v")).first().v
    assert v.startswith('{"e":"kline"')


def test_rest_pages_round_trip_and_empty_page(spark):
    pages = spark.createDataFrame([("A", 0, '[[1700000000000,"1.5","2","1","1.75","10",1700000059999,"17.5",3,"4","7","0"]]'),
                                   ("A", 1, "[]")], "symbol string, page_no long, page string")
    d = kl.decode_rest_pages(pages).collect()
    assert len(d) == 1 and d[0].open_time == 1700000000000 and d[0].close == "1.75" and d[0].num_trades == 3


def test_csv_archive_symbol_from_path_and_epoch_units(spark, tmp_dir):
    rows = spark.createDataFrame(
        [("AAA1", 1700000000000, "1", "2", "0.5", "1.5", "3", 1700000059999, "4", 5, "1", "1", "0"),
         ("BBB2", 1700000000000000, "1", "2", "0.5", "bad", "3", 1700000059999, "4", 5, "1", "1", "0")],
        "symbol string, open_time long, open string, high string, low string, close string, volume string, "
        "close_time long, quote_volume string, num_trades long, taker_buy_base string, taker_buy_quote string, "
        "ignore string")
    for sym in ["AAA1", "BBB2"]:
        rows.filter(F.col("symbol") == sym).drop("symbol").coalesce(1).write.csv(f"{tmp_dir}/klines/{sym}")
    raw = kl.read_kline_csv(spark, f"{tmp_dir}/klines/*/*.csv")
    n = kl.normalise_klines(raw).orderBy("symbol").collect()
    assert [r.symbol for r in n] == ["AAA1", "BBB2"]
    assert n[0].open_time_ms == 1700000000000 and n[1].open_time_ms == 1700000000000
    assert n[0].close_num == 1.5 and n[1].close_num is None


def test_checksums_good_bad_missing(spark):
    docs = table(spark, SF_SMALL, "documents")
    content, manifest = enc.checksum_manifest(docs)
    v = ar.verify_checksums(content, manifest)
    counts = {r.status: r["count"] for r in v.groupBy("status").count().collect()}
    n_bad = docs.filter("source = 'src7'").count()
    assert counts.get("mismatch", 0) == n_bad and counts["ok"] == docs.count() - n_bad
    extra = manifest.limit(3).withColumn("file_name", F.concat("file_name", F.lit(".x")))
    v2 = ar.verify_checksums(content, manifest.unionByName(extra))
    assert v2.filter("status = 'missing_file'").count() == 3


def test_zip_unpack_with_broken_archive(spark):
    good = ar.zip_text("a.csv", "1,2\n3,4\n")
    df = spark.createDataFrame([("a.zip", bytearray(good)), ("b.zip", bytearray(b"not a zip"))],
                               "file_name string, content binary")
    rows = ar.unpack_zip(df).collect()
    assert sorted((r.file_name, r.line) for r in rows if r.line) == [("a.zip", "1,2"), ("a.zip", "3,4")]
    assert [r.file_name for r in rows if r.member is None] == ["b.zip"]


def test_manifest_anti_join(spark):
    syms = spark.createDataFrame([("A",), ("B",)], "symbol string")
    wanted = ar.work_manifest(syms, F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date"))
    assert wanted.count() == 6
    present = spark.createDataFrame([("A", "2024-01-02")], "symbol string, p string").select(
        "symbol", F.col("p").cast("date").alias("period"))
    missing = ar.missing_files(wanted, present, ["symbol", "period"])
    assert missing.count() == 5
    assert wanted.filter("symbol = 'A'").orderBy("period").first().file_name == "A-1h-2024-01-01"


def test_unreadable_pages_are_reported_and_the_rest_is_kept(spark):
    page = '[[1704067200000,"1","2","0.5","1.5","10",1704070799999,"15",3,"5","7","0"]]'
    pages = spark.createDataFrame([("A", 0, page), ("A", 1, page[:-9]), ("A", 2, "[]"), ("A", 3, None)],
                                  "symbol string, page_no int, page string")
    got = {r.page_no: (r.status, r.n_rows) for r in kl.rest_page_status(pages).collect()}
    assert got == {0: ("ok", 1), 1: ("unreadable", 0), 2: ("empty", 0), 3: ("unreadable", 0)}
    assert kl.decode_rest_pages(pages).count() == 1
    none = kl.warmup_closes(kl.decode_rest_pages(pages.filter("page_no = 2")))
    assert none.count() == 0 and none.columns == ["symbol", "bar_time", "close"]


def test_broken_member_gives_a_null_line(spark):
    good = ar.zip_text("a.csv", "1,2\n3,4\n")
    blob = ar.zip_text("b.csv", "x" * 5000 + "".join(str(i) for i in range(3000)))
    cut = len(blob) // 2
    bad = blob[:cut] + bytes([blob[cut] ^ 0xFF, blob[cut + 1] ^ 0xFF]) + blob[cut + 2:]
    d = spark.createDataFrame([("good.zip", good), ("bad.zip", bad)], "file_name string, content binary")
    got = ar.unpack_zip(d).collect()
    assert sorted(r.line for r in got if r.file_name == "good.zip") == ["1,2", "3,4"]
    assert [(r.member, r.line) for r in got if r.file_name == "bad.zip"] == [("b.csv", None)]


def test_checksums_of_binary_files(spark, tmp_dir):
    """The binaryFile source against a manifest."""
    import hashlib
    import os
    os.makedirs(f"{tmp_dir}/f")
    lines = []
    for name, data in (("a.zip", b"one"), ("b.zip", b"two")):
        with open(f"{tmp_dir}/f/{name}", "wb") as f:
            f.write(data)
        lines.append((name, hashlib.sha256(data if name == "a.zip" else b"other").hexdigest() + "  " + name))
    manifest = spark.createDataFrame(lines, "file_name string, line string")
    got = {r.file_name: r.status for r in ar.verify_checksums(ar.binary_files(spark, f"{tmp_dir}/f/*.zip"), manifest).collect()}
    assert got == {"a.zip": "ok", "b.zip": "mismatch"}


def test_key_partition_is_that_of_the_hash_balancer(spark):
    """K4: FNV-1a over the bytes, signed, remainder without its sign; a key's records stay together and in order."""
    from volcast.sources import messages as msg

    def balancer(key, n):
        h = 2166136261
        for b in key:
            h = (h ^ b) * 16777619 & 0xFFFFFFFF
        h = h - (1 << 32) if h >> 31 else h
        return abs(int(math.fmod(h, n)))

    keys = [b"", b"a", b"BTCUSDT", "żółw🙂".encode(), bytes(range(256)), b"\x00\xff", None]
    d = spark.createDataFrame([(bytearray(k) if k is not None else None, f"v{i}".encode(), i) for i, k in enumerate(keys * 5)],
                              "key binary, value binary, at long")
    for n in (1, 3, 12):
        for r in d.withColumn("p", msg.key_partition("key", n)).collect():
            assert r.p == (None if r.key is None else balancer(bytes(r.key), n))
    # b"a" has the published 32-bit FNV-1a hash e40c292c
    assert balancer(b"a", 1 << 31) == abs(0xE40C292C - (1 << 32))
    laid = msg.by_partition(d.coalesce(1), 3).withColumn("task", F.spark_partition_id()).collect()
    assert len(laid) == 35 and all(len({r.task for r in laid if r.key == k}) == 1 for k in map(lambda k: k and bytearray(k), keys[1:6]))
    import pytest
    with pytest.raises(ValueError):
        msg.key_partition("key", 0)


def test_files_are_written_whole_and_held_against_manifest_files(spark, tmp_dir):
    """Lines of many partitions give one file per name, byte for byte; the manifest is text with odd lines."""
    import hashlib

    from volcast.sinks.files import write_lines
    rows = [(f"f{i % 3}.csv", i, f"{i},x") for i in range(300)]
    write_lines(spark.createDataFrame(rows, "n string, i int, line string").repartition(16), f"{tmp_dir}/files", "n", ["i"])
    digest = [hashlib.sha256("".join(r[2] + "\n" for r in rows if r[0] == f"f{k}.csv").encode()).hexdigest() for k in range(3)]
    with open(f"{tmp_dir}/SHA256SUMS", "w") as f:
        f.write(f"{digest[0]}  f0.csv\n\n{digest[1].upper()} *f1.csv\n{digest[1]}  gone file.csv\n   \n")
    content = ar.binary_files(spark, f"{tmp_dir}/files", r"n=([^/]+)/", recursive=True).where("file_name <> ''")
    got = sorted((r.file_name, r.status) for r in ar.verify_checksums(content, ar.manifest_lines(spark, f"{tmp_dir}/SHA256SUMS")).collect())
    assert got == [("f0.csv", "ok"), ("f1.csv", "ok"), ("f2.csv", "missing_checksum"), ("gone file.csv", "missing_file")]
