"""The stream's URL ledger: exactly once, only hit buckets read, replays after failures."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from penmark.sources import files as IO
from penmark.streaming import ingest as ST


def articles(spark, *urls):
    return spark.createDataFrame([(u, "a", "h", "b") for u in urls], "url string, author string, headline string, body string")


def urls(spark, store):
    return sorted(str(r["url"]) for r in ST.stored_articles(spark, store).collect())


@pytest.fixture()
def dirs(tmp_path):
    return [str(tmp_path / x) for x in ("in", "store", "ckpt", "ledger")]


def test_stream_with_ledger_is_exactly_once(spark, dirs):
    src, store, ckpt, ledger = dirs
    IO.append_articles(articles(spark, "u1", "u2"), store)
    articles(spark, *[f"u{i}" for i in range(8)], "u3", None, None).write.mode("append").json(src)
    ST.stream_ingest(spark, src, store, ckpt, ledger_dir=ledger)
    articles(spark, "u7", "u8", None).write.mode("append").json(src)
    ST.stream_ingest(spark, src, store, ckpt, ledger_dir=ledger)
    want = ["None", *[f"u{i}" for i in range(9)]]
    assert urls(spark, store) == want
    # another checkpoint reads all files again and adds nothing
    ST.stream_ingest(spark, src, store, ckpt + "2", ledger_dir=ledger)
    assert urls(spark, store) == want


def test_a_batch_reads_its_own_buckets_only(spark, dirs, monkeypatch):
    _, store, _, ledger = dirs
    IO.append_articles(articles(spark, *[f"u{i}" for i in range(30)]), store)
    n = ST.seed_ledger(spark, store, ledger)
    batch = articles(spark, "u3", "new")
    hit = {r[0] for r in batch.select(ST._bucket(n)).collect()}
    for folder in Path(ledger, "urls").glob("bucket=*"):
        if int(folder.name.split("=")[1]) not in hit:
            (folder / "part-bad.parquet").write_bytes(b"not a table")   # reading it would fail
    monkeypatch.setattr(ST, "_stored_urls", lambda *a: pytest.fail("the store must not be read"))
    ST.ingest_batch(batch, "q-0", store, ledger, n)
    assert urls(spark, store).count("u3") == 1 and "new" in urls(spark, store)


def test_replay_after_a_failure_between_store_and_ledger(spark, dirs, monkeypatch):
    _, store, _, ledger = dirs
    n = ST.seed_ledger(spark, store, ledger)
    batch = articles(spark, "a", "b")
    with monkeypatch.context() as m:
        m.setattr(ST, "_ledger_append", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ST.ingest_batch(batch, "q-0", store, ledger, n)
    assert urls(spark, store) == ["a", "b"]
    ST.ingest_batch(batch, "q-0", store, ledger, n)           # stored already: only the ledger is mended
    ST.ingest_batch(articles(spark, "b", "c"), "q-1", store, ledger, n)
    ST.ingest_batch(articles(spark, "b", "c"), "q-1", store, ledger, n)
    assert urls(spark, store) == ["a", "b", "c"]


def test_empty_batch(spark, dirs):
    _, store, _, ledger = dirs
    IO.append_articles(articles(spark, "u"), store)
    n = ST.seed_ledger(spark, store, ledger)
    ST.ingest_batch(articles(spark, "x").filter(F.lit(False)), "q-0", store, ledger, n)
    assert urls(spark, store) == ["u"]


def files(ledger):
    out = {}
    for f in Path(ledger, "urls").glob("bucket=*/part-*"):
        out.setdefault(f.parent.name, []).append(f.name)
    return out


def ledger_rows(spark, ledger):
    return sorted(str(r["url"]) for r in spark.read.schema("url string").parquet(f"{ledger}/urls").collect())


def test_full_buckets_become_one_file(spark, dirs, monkeypatch):
    _, store, _, ledger = dirs
    monkeypatch.setattr(ST, "COMPACT_FILES", 2)
    n = ST.seed_ledger(spark, store, ledger, buckets=2)
    for i in range(5):
        ST.ingest_batch(articles(spark, *[f"u{j}" for j in range(4 * i, 4 * i + 8)], None), f"q-{i}", store, ledger, n)
        assert all(len(x) <= 2 for x in files(ledger).values())
    want = ["None", *sorted(f"u{j}" for j in range(24))]
    assert urls(spark, store) == want and ledger_rows(spark, ledger) == want
    assert ST.compact_ledger(spark, ledger, n, max_files=100) == []
    assert ST.compact_ledger(spark, ledger, n, hit=[]) == []


def test_failure_while_compacting_loses_no_url(spark, dirs, monkeypatch):
    """Old files are removed last; a URL that is in the ledger twice changes nothing."""
    _, store, _, ledger = dirs
    n = ST.seed_ledger(spark, store, ledger, buckets=1)
    for i in range(4):
        ST.ingest_batch(articles(spark, f"u{i}"), f"q-{i}", store, ledger, n)
    left = []
    with monkeypatch.context() as m:
        def fails_second(s, path, real=ST.remove_path):
            left.append(path)
            if len(left) == 2:
                raise OSError("lost")
            real(s, path)
        m.setattr(ST, "remove_path", fails_second)
        with pytest.raises(OSError):
            ST.compact_ledger(spark, ledger, n, max_files=1)
    assert set(ledger_rows(spark, ledger)) == {f"u{i}" for i in range(4)}
    ST.ingest_batch(articles(spark, "u0", "u3", "u4"), "q-4", store, ledger, n)
    assert urls(spark, store) == [f"u{i}" for i in range(5)]
    assert ST.compact_ledger(spark, ledger, n, max_files=1) == [0]
    assert ledger_rows(spark, ledger) == [f"u{i}" for i in range(5)] and len(files(ledger)["bucket=0"]) == 1
