"""A refresh that stops leaves readers the old version; one that ends swaps all."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F
from test_etl_fixtures import LOCATIONS, ORDERS, RESTAURANTS, USERS
from test_streaming import HEADER, LINES

from thalimart.__main__ import main
from thalimart.plans import published, warehouse
from thalimart.sources.staging import read_csv_staging


def _staging(spark, folder, lines):
    folder.mkdir(exist_ok=True)
    for name, text in (("users", USERS), ("restaurants", RESTAURANTS), ("locations", LOCATIONS), ("orders", "\n".join([HEADER, *lines]) + "\n")):
        (folder / f"{name}.csv").write_text(text)
    return read_csv_staging(spark, *(str(folder / f"{n}.csv") for n in ("users", "restaurants", "orders", "locations")))


def _facts(wh):
    return sorted(r.order_nk for r in wh.fact.collect())


def test_build_stopped_midway_leaves_the_old_version(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "wh")
    old = published.refresh(spark, _staging(spark, tmp_path / "a", LINES[:6]), base)
    facts, before = _facts(old), published.manifests(spark, base)
    whole = _staging(spark, tmp_path / "b", LINES)

    # cells that cannot be computed: the fact's job fails after the dimensions are written
    broken = dataclasses.replace(whole, orders=whole.orders.withColumn("currency", F.raise_error(F.lit("stopped"))))
    with pytest.raises(Exception, match="stopped"):
        published.refresh(spark, broken, base)
    assert published.manifests(spark, base) == before
    assert _facts(published.open_current(spark, base)) == facts

    # stopped between the dimensions and the fact
    def stop(*_, **__):
        raise RuntimeError("stopped here")
    with monkeypatch.context() as m:
        m.setattr(warehouse.etl, "build_fact_wide", stop)
        with pytest.raises(RuntimeError, match="stopped here"):
            published.refresh(spark, whole, base)
    assert _facts(published.open_current(spark, base)) == facts

    new = published.refresh(spark, whole, base)
    assert len(_facts(new)) > len(facts)
    assert _facts(published.open_current(spark, base)) == _facts(new)
    assert _facts(old) == facts  # frames opened before still read their version


def test_wrong_keys_are_not_published(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "wh")
    published.refresh(spark, _staging(spark, tmp_path / "a", LINES[:6]), base)
    before = published.manifests(spark, base)
    twice = published.build_warehouse

    def doubled(*args):
        wh = twice(*args)
        return dataclasses.replace(wh, orders=wh.orders.unionByName(wh.orders))
    with monkeypatch.context() as m:
        m.setattr(published, "build_warehouse", doubled)
        with pytest.raises(ValueError, match="fact_order.order_key"):
            published.refresh(spark, _staging(spark, tmp_path / "b", LINES), base)
    assert published.manifests(spark, base) == before


def test_old_versions_go_and_a_taken_number_is_not_overwritten(spark, tmp_path):
    base = str(tmp_path / "wh")
    staging = _staging(spark, tmp_path / "a", LINES[:4])
    for _ in range(3):
        published.refresh(spark, staging, base, keep=1)
    assert len(list((tmp_path / "wh" / "versions").iterdir())) == 2
    assert len(published.manifests(spark, base)) == 2
    files = published._Files(spark, base)
    taken = published.manifests(spark, base)[-1]
    assert not files.put(f"manifest/{taken}", "{}")
    assert published.current(spark, base) is not None


def test_command_line_refresh_and_query(spark, tmp_path, capsys):
    _staging(spark, tmp_path / "in", LINES)
    base, out = str(tmp_path / "wh"), str(tmp_path / "out")
    assert main(["refresh", str(tmp_path / "in"), base]) == 0
    assert main(["query", base, "qa_row_counts", "--out", out]) == 0
    counts = {r.t: r.c for r in spark.read.parquet(out).collect()}
    assert counts["fact_order"] == published.open_current(spark, base).fact.count() > 0
    assert ORDERS and main(["list"]) == 0 and "state_loyalty" in capsys.readouterr().out
