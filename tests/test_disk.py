"""What the layers behind the controls and incidents leave on disk, and that working in parts changes no result."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import anomaly, census, quality, rootcause
from tidemark.operators.census import Census, Source, Use
from tidemark.plans import bindings
from tidemark.plans.bindings import SCHEMAS, Tables


def shuffle_files(spark):
    manager = spark._jsc.sc().env().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {str(files.apply(i)) for i in range(files.size()) if "shuffle_" in str(files.apply(i))}


def stored(tables):
    """Bytes of every stored layer."""
    sizes = {}
    top = Path(session._layer(tables.spark, tables.label).removeprefix("file:"))
    for path in top.glob("*/*.parquet") if top.exists() else []:
        name = path.parent.name.rsplit("-", 1)[0]
        sizes[name] = sizes.get(name, 0) + path.stat().st_size
    return sizes


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two busy weeks at one hub within a quiet year, rows that come twice, NULL keys and keys without a parent."""
    top, rng = tmp_path_factory.mktemp("star"), random.Random(5)
    lines = []
    for i in range(6000):
        day = rng.randrange(360) if i % 3 else 150 + rng.randrange(14)
        hot = 150 <= day < 164
        line = (
            rng.choice([None, 9000, *range(1500)]) if i % 50 == 0 else rng.randrange(1500),
            rng.randrange(200),
            (3 if hot and i % 2 else rng.randrange(20)) if i % 70 else rng.choice([None, 77]),
            rng.choice([None, 7]) if i % 90 == 0 else rng.randrange(1, 8),
            float(rng.randrange(30, 50) if hot else rng.randrange(1, 30)),
            float(rng.randrange(1, 900)),
            None if i % 80 == 0 else rng.randrange(11) / 100,
            rng.randrange(9) / 100,
            ("R" if hot else rng.choice("NNNARN")) if i % 60 else None,
            rng.choice("OF"),
            None if i % 200 == 0 else f"2024-{1 + day // 30:02d}-{1 + day % 30 % 28:02d} 00:00:00",
        )
        lines += [line, line] if i % 100 == 0 else [line]
    orders = [(i % 1480, rng.choice([None, *range(120)]), rng.choice("FOP"), 100.0 + i, f"2024-{1 + i % 12:02d}-03 00:00:00", rng.choice(["1-URGENT", "5-LOW"])) for i in range(1480)]
    rows = {
        "region": [(0, "R"), (1, "Q")],
        "nation": [(i, f"N{i}", i % 2) for i in range(5)],
        "customer": [(i, f"c{i}", i % 6, 1.0, "S") for i in range(100)],
        "supplier": [(i, f"s{i}", i % 5, 9.0) for i in range(20)],
        "part": [(1, "p", "b", "t", 1, 1.0)],
        "orders": orders,
        "lineitem": lines,
        "events": [(i // 2, "2024-01-01 00:00:00", i % 9, rng.choice(["purchase", "view"]), 3.0, "{}") for i in range(300)],
        "conversations": [(1, 0, "user", "t")],
    }
    for name, own in rows.items():
        fields = [part.strip().split(" ") for part in SCHEMAS[name].split(",")]
        text = ", ".join(f"{n} {'string' if t == 'timestamp_ntz' else t}" for n, t in fields)
        df = spark.createDataFrame(own, text).selectExpr(*[f"cast({n} as {t}) as {n}" for n, t in fields])
        df.write.parquet(str(top / f"{name}.parquet"))
    return str(top)


@pytest.fixture
def large(monkeypatch):
    """Every input counts as large."""
    monkeypatch.setattr(bindings, "LARGE", -1)
    monkeypatch.setattr(census, "LARGE", -1)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_small_and_large_tables_give_the_same(spark, folder, monkeypatch):
    whole = Tables(spark, folder, "whole")
    names = ["stored_shipments", "cases", "controls", "support_cells", "incidents", "carrier_facts", "support_periods", "registry"]
    want = {name: rows_of(getattr(whole, name)) for name in names}
    monkeypatch.setattr(bindings, "LARGE", -1)
    monkeypatch.setattr(census, "LARGE", -1)
    parts = Tables(spark, folder, "parts")
    assert len(parts._line_parts()) > 1
    assert {name: rows_of(getattr(parts, name)) for name in names} == want
    assert want["incidents"] and want["support_periods"]


def test_stored_rows_are_those_derived_from_the_lines(spark, folder, large):
    tables = Tables(spark, folder, "rows")
    assert rows_of(tables.stored_shipments.drop("shipment_date")) == rows_of(tables.shipments)
    assert rows_of(tables.cases) == rows_of(tables.derived_cases)


def test_layers_hold_no_ids_as_text_and_no_events(spark, folder, large):
    tables = Tables(spark, folder, "layers")
    assert tables.tracking.count() == 3 * tables.lines.count()
    tables.controls.count()
    sizes = stored(tables)
    assert set(sizes) >= {"shipments", "cases", "controls"} and "tracking" not in sizes
    text = tables.stored_shipments.select("shipment_id", "expected_delivery_ts").union(tables.cases.select("case_id", "resolved_ts"))
    path = session.new_folder(spark, "layers/text")
    text.write.option("compression", "zstd").parquet(path)
    assert sizes["shipments"] + sizes["cases"] < sum(f.stat().st_size for f in Path(path.removeprefix("file:")).glob("*.parquet")) * 1.5


def test_jobs_leave_no_shuffles(spark, folder, large):
    tables = Tables(spark, folder, "shuffles")
    before = shuffle_files(spark)
    for name in ("controls", "candidates", "incidents", "registry"):
        getattr(tables, name)
        assert not shuffle_files(spark) - before, name


def test_setting_is_put_back(spark):
    before = spark.conf.get(session.CLEANUP, None)
    with pytest.raises(ZeroDivisionError), session.shuffles_deleted(spark):
        assert spark.conf.get(session.CLEANUP) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(session.CLEANUP, None) == before


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(9)
    up = spark.createDataFrame([(rng.choice([None, *range(40)]),) for _ in range(60)], "k int")
    down = [(str(i % 300), rng.choice([None, 7, 7, *range(60)]), rng.randrange(-3, 9), rng.choice(["7", None, "x"])) for i in range(400)]
    down = spark.createDataFrame([*down, (None, 1, None, None)], "id string, k bigint, v int, word string")
    return lambda: [
        Source(up, [Use("thing", "up", "k"), Use("other", "up", "k")]),
        Source(
            down,
            [
                Use("thing", "down", "k"), Use("thing", "big", "k", F.col("v") > 5, F.col("v")), Use("thing", "odd", F.col("k") + 1, F.col("v") > 0),
                Use("line", "line", "id"), Use("other", "word", "word"),
            ],
            {"negative": F.col("v") < 0, "blank": F.col("k").isNull().cast("int") + F.col("v").isNull().cast("int")},
        ),
    ]


def asked(found):
    return {
        "up": found.surplus("thing", "up"),
        "lines": found.surplus("line", "line"),
        "orphans": found.orphans("thing", "down", "up"),
        "words": found.orphans("other", "word", "up"),
        "many": found.keys_where("thing", found.count("thing", "down") > 3),
        "top": found.rows_where("thing", "big", F.col("top") == 8) + found.rows_where("thing", "odd", ~found.unknown()),
        "negative": found.broken("negative"),
        "blank": found.broken("blank"),
        "given": F.lit(4).cast("bigint"),
    }


@pytest.mark.parametrize("shares", [2, 8, 50])
def test_passes_add_up_to_one_census(spark, sources, shares):
    one, many = Census(sources(), 1), Census(sources(), shares)
    want = one.totals(asked(one)).first().asDict()
    assert many.totals(asked(many)).first().asDict() == want
    assert want["given"] == 4 and all(want[name] for name in ("up", "lines", "orphans", "words", "many", "top", "negative", "blank"))


def test_a_pass_holds_a_share_of_the_keys(spark, sources):
    found = Census(sources(), 8)
    keys = [{r.text for r in found._pass("line", i, 4).collect()} for i in range(4)]
    assert sum(map(len, keys)) == len(set.union(*keys)) == 301 and max(map(len, keys)) < 150


def test_cells_of_shares_add_up(spark, folder):
    tables = Tables(spark, folder, "cells")
    whole = anomaly.support_cells(tables.stored_shipments, tables.cases)
    shares = anomaly.support_shares(tables.stored_shipments, tables.cases, 3)
    every = shares[0].unionByName(shares[1]).unionByName(shares[2])
    assert rows_of(anomaly.joined_cells(every).select(*whole.columns)) == rows_of(whole)


def test_carrier_facts_of_shares_add_up(spark, folder):
    tables = Tables(spark, folder, "carriers")
    days = spark.sql(
        "select 'a' candidate_incident_id, 'HUB-3' warehouse_id, 'incident' period, explode(sequence(date'2024-05-20', date'2024-06-20')) report_date"
        " union all select 'b', 'HUB-9', 'baseline', date'2024-05-21'"  # a hub without shipments keeps a row of NULLs
    )
    whole = rootcause.carrier_periods(tables.stored_shipments, days)
    shares = rootcause.carrier_shares(tables.stored_shipments, days, 3)
    every = rootcause.joined_periods(shares[0].unionByName(shares[1]).unionByName(shares[2]))
    assert rows_of(every.select(*whole.columns)) == rows_of(whole) and whole.count() > 5


def test_controls_of_empty_tables_in_passes(spark, large):
    orders = spark.createDataFrame([], "order_id bigint")
    lines = spark.createDataFrame([], "line_id string, order_id bigint")
    tables = {"orders": (orders, quality.TableRules(["order_id"], ["order_id"], ["order_id"])), "lines": (lines, quality.TableRules(["line_id"], ["line_id", "x"], ["line_id"]))}
    got = {r.control_id: int(r.observed_num) for r in quality.census_controls(tables, [quality.Reference("lines", "orders", "order_id")]).collect()}
    assert got == {"ORDERS_SCHEMA": 0, "ORDERS_PK": 0, "ORDERS_CRITICAL_NULLS": 0, "LINES_SCHEMA": 1, "LINES_PK": 0, "LINES_CRITICAL_NULLS": 0, "LINES_ORDERS_FK": 0}
