import datetime as dt
import random
import time

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pricelens.operators import forest
from pricelens.operators import trees as growing
from pricelens.plans.runs import Landed, PriceRun, Settings
from pricelens.sources import files, schemas
from pricelens.sources.store import RunState, SuggestionStore

TRAIN = ("volume_liters double, price_per_liter double, approved_quote_price double, "
         "type_of_product string, subindustry string, channel string")


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = []
    for i in range(800):
        kind, size = f"T{i % 4}", rng.choice([0.25, 0.5, 1.0, 5.0])
        price = 10.0 * (i % 4 + 1) + 4 / size + rng.uniform(-0.5, 0.5)
        rows.append((size, price, 0.0, kind if i % 50 else None, "Home", "B2C"))
    train = spark.createDataFrame(rows, TRAIN)
    path = str(tmp_path_factory.mktemp("model") / "m")
    forest.save_model(forest.fit_forest(train, "volume_liters", "price_per_liter", trees=12), path)
    return train, path


def products_of(spark):
    return spark.createDataFrame(
        [(f"P{i}", float(i % 5 + 1) / 2, 0.0, kind, "Home", "B2C")
         for i, kind in enumerate(["T0", "T1", "T2", "T3", "never seen", None])],
        "product_id string, volume_liters double, approved_quote_price double, "
        "type_of_product string, subindustry string, channel string")


def test_trees_rebuild_the_prediction(spark, trained):
    _, path = trained
    model = forest.load_model(path)
    spread = forest.with_tree_spread(model.transform(products_of(spark)), model.stages[-1])
    rows = spread.select("unit_price", "tree_mean", "tree_spread").collect()
    assert len(rows) == 6
    for r in rows:
        assert r.tree_mean == pytest.approx(r.unit_price, rel=1e-9) and r.tree_spread >= 0


def test_every_product_keeps_its_row(spark, trained):
    """Repeated and null ids, a missing size, a missing quote price, a clashing column."""
    _, path = trained
    products = products_of(spark).unionByName(products_of(spark).limit(1)).unionByName(
        spark.createDataFrame(
            [(None, 1.0, 0.0, "T0", "Home", "B2C"), (None, 2.0, 0.0, "T3", "Home", "B2C"),
             ("no size", None, 0.0, "T1", "Home", "B2C"), ("no quote", 1.0, None, "T1", "Home", "B2C")],
            products_of(spark).schema)).withColumn("features", F.lit("clash"))
    rows = forest.predict(products, path, "volume_liters").collect()
    assert sorted(str(r.product_id) for r in rows) == sorted(str(r.product_id) for r in products.collect())
    for r in rows:
        priced = r.product_id not in ("no size", "no quote")
        assert (r.predicted_price_per_unit is not None) == (r.model_confidence is not None) == priced
        assert not priced or 0 <= r.model_confidence <= 100
    first, second = (r for r in rows if r.product_id is None)
    assert first.predicted_price_per_unit != second.predicted_price_per_unit


def test_known_types_are_priced_well(spark, trained):
    train, path = trained
    scored = forest.load_model(path).transform(train.fillna(forest.UNKNOWN))
    error = scored.agg(F.avg(F.abs(F.col("unit_price") - F.col("price_per_liter")))).first()[0]
    assert error < 1.5
    score = forest.holdout_score(train, "volume_liters", "price_per_liter", trees=8)
    assert score > 0.9


def test_unseen_types_encode_to_zeros(spark, trained):
    _, path = trained
    rows = forest.load_model(path).transform(products_of(spark)).select(
        "product_id", vector_to_array("type_of_product_flags").alias("flags")).collect()
    flags = {r.product_id: sum(r.flags) for r in rows}
    assert flags == {"P0": 1, "P1": 1, "P2": 1, "P3": 1, "P4": 0, "P5": 0}


def test_confidence(spark):
    frame = spark.createDataFrame([(10.0, 1.0), (10.0, 6.0), (0.0, 1.0)], "m double, s double")
    assert [r[0] for r in frame.select(forest.confidence(F.col("m"), F.col("s"))).collect()] == [80.0, 0.0, 0.0]


def records_of(spark, ids):
    return spark.createDataFrame([(i, 1.0, 1) for i in ids], "product_id_str string, x double, c int").select(
        "product_id_str",
        *[F.lit("t").alias(c) for c in ("product_type", "generic_product_type", "subindustry", "industry", "product_name")],
        *[F.col("x").alias(c) for c in schemas.SUGGESTION_COLUMNS
          if c not in ("product_id_str", "product_type", "generic_product_type", "subindustry",
                       "industry", "product_name", "competitors_count")],
        F.col("c").alias("competitors_count"))


def ids_of(df):
    return [] if df is None else sorted(r.product_id_str for r in df.collect())


def test_store_keeps_history_and_repeats_safely(spark, tmp_path):
    store = SuggestionStore(spark, str(tmp_path))
    day = lambda n: dt.datetime(2025, 1, n)
    assert store.current() is None and store.history() is None
    store.publish(records_of(spark, "ab"), "r1", "full", day(1))
    store.publish(records_of(spark, "c"), "r2", "partial", day(2))
    store.publish(records_of(spark, "c"), "r2", "partial", day(2))
    assert ids_of(store.current()) == ["a", "b", "c"] and ids_of(store.history()) == []
    store.publish(records_of(spark, "xy"), "r3", "full", day(3))
    store.publish(records_of(spark, "xy"), "r3", "full", day(3))
    assert ids_of(store.current()) == ["x", "y"] and ids_of(store.history()) == ["a", "b", "c"]
    created = {r.product_id_str: r.original_create_date for r in store.history().collect()}
    assert created == {"a": day(1), "b": day(1), "c": day(2)}
    store.publish(records_of(spark, "z"), "r4", "full", day(4))
    assert ids_of(store.history()) == ["a", "b", "c", "x", "y"]
    with pytest.raises(ValueError):
        store.publish(records_of(spark, "z"), "r5", "other", day(5))


def test_a_run_that_dies_before_the_commit_is_not_seen(spark, tmp_path, monkeypatch):
    store = SuggestionStore(spark, str(tmp_path))
    store.publish(records_of(spark, "a"), "r1", "full", dt.datetime(2025, 1, 1))
    with monkeypatch.context() as broken:
        broken.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.publish(records_of(spark, "b"), "r2", "full", dt.datetime(2025, 1, 2))
    assert ids_of(store.current()) == ["a"] and ids_of(store.history()) == []
    store.publish(records_of(spark, "b"), "r2", "full", dt.datetime(2025, 1, 2))
    assert ids_of(store.current()) == ["b"] and ids_of(store.history()) == ["a"]


@pytest.mark.parametrize("mode", ["partial", "full"])
def test_of_two_publishers_none_is_lost(spark, tmp_path, monkeypatch, mode):
    one, other = SuggestionStore(spark, str(tmp_path)), SuggestionStore(spark, str(tmp_path))
    one.publish(records_of(spark, "a"), "r1", "full", dt.datetime(2025, 1, 1))
    commit = one._commit

    def late(*row):
        """Another run is published while this one is about to commit."""
        monkeypatch.setattr(one, "_commit", commit)
        other.publish(records_of(spark, "b"), "r2", "partial", dt.datetime(2025, 1, 2))
        got = commit(*row)
        assert not got
        return got

    monkeypatch.setattr(one, "_commit", late)
    one.publish(records_of(spark, "c"), "r3", mode, dt.datetime(2025, 1, 2))
    if mode == "partial":
        assert ids_of(one.current()) == ["a", "b", "c"] and ids_of(one.history()) == []
    else:
        assert ids_of(one.current()) == ["c"] and ids_of(one.history()) == ["a", "b"]
    assert one._newest()[0] == 3 and not list((tmp_path / "publish_claims").iterdir())


def test_run_state(spark, tmp_path):
    state = RunState(spark, str(tmp_path))
    with pytest.raises(LookupError):
        state.require_last_full_run()
    state.finished("r1", "full", dt.datetime(2025, 1, 1))
    state.finished("r2", "partial", dt.datetime(2025, 1, 9))
    assert state.last_full_run() == dt.datetime(2025, 1, 1)
    assert state.current_runs() == ["r1", "r2"]
    state.finished("r3", "full", dt.datetime(2025, 1, 20))
    state.finished("r4", "partial", dt.datetime(2025, 1, 21))
    state.finished("r4", "partial", dt.datetime(2025, 1, 22))  # repeated
    assert state.current_runs() == ["r3", "r4"]


def landed(spark, new_product=False):
    link = lambda name: f'[1, "{name}"]'
    columns = ", ".join(
        f"{c} " + ("timestamp_ntz" if c == "create_date" else
                   "double" if c.endswith(("cost", "costs", "_sar", "liters", "units")) else "string")
        for c in ["status", *schemas.ERP_CATALOG_COLUMNS]) + ", seq int"
    base = dict.fromkeys(schemas.ERP_CATALOG_COLUMNS)

    def product(i, kind, sub, liters=None, pack=None, created=dt.datetime(2025, 1, 1)):
        return ("active", *{**base, "create_date": created, "product_id": f"FP-{i}", "product_name": kind,
                            "type_of_product_id": link(kind), "subindustry_id": link(sub),
                            "industry_id": link("Living"), "generic_product_type": "Cleaner",
                            "volume_liters": liters, "pack_quantity_units": pack, "unit_cost_sar": 4.0}.values(), -i)

    products = [product(1, "H2-Glass cleaner", "Home", 0.75), product(2, "H9-Floor wipes", "Home", None, 40.0),
                product(3, "H5-Never sold", "Home", 1.0)]
    if new_product:
        products.append(product(4, "H2-Glass cleaner", "Home", 1.5, created=dt.datetime(2025, 3, 5)))
    pages = []
    for i in range(12):
        pages.append(("saco", "glass cleaner", "volume", f"https://s.example/{i}",
                      f'<h1 class="product-title">Glass Cleaner {i + 1}00 ml</h1>'
                      f'<span class="discount-price">{i + 5}<sup>50</sup></span>', i))
        pages.append(("mumzworld", "floor wipes", "units", f"https://m.example/{i}",
                      f'<h1 class="ProductDetails_productName__lcVK_">Acme - Floor Wipes {i + 10} wipes</h1>'
                      f'<span class="Price_integer__3ngZQ">{i + 9}</span>', i))
    pages.append(("saco", "never planned", "volume", "https://s.example/n", "<h1>x</h1>", 0))
    return Landed(
        catalog=spark.createDataFrame(products, columns),
        lines=spark.createDataFrame([(1, "[FP-1] a", 2.0, 30.0, 1), (1, "[FP-2] b", 1.0, 20.0, 2)],
                                    "order_id int, name string, product_uom_qty double, price_subtotal double, seq int"),
        orders=spark.createDataFrame([(1, "sale", dt.datetime(2025, 2, 1))],
                                     "order_id int, state string, date_order timestamp_ntz"),
        competitors=spark.createDataFrame(
            [("2025-01-01", "b2b", link("H2-Glass cleaner"), "c", link("Home"), link("Living"), "Cleaner", 500.0, "ml", 9.0, "Z")],
            "date string, product_channel string, classification_id string, product_category string, subindustry_id string, "
            "industry_id string, generic_product_type string, total_quantity double, uom string, price_unit_sar double, company string"),
        pages=spark.createDataFrame(pages, "site string, search_keyword string, search_mode string, url string, html string, position int"),
    )


def test_full_then_partial_run(spark, tmp_path):
    run = PriceRun(spark, str(tmp_path), Settings(quote_year=2025, trees=5, max_depth=4))
    assert run.run(landed(spark), "r1", dt.datetime(2025, 3, 1)) == "full"
    report = {r.product_id: r for r in run.read("report").collect()}
    assert report.keys() == {"FP-1", "FP-2"}  # FP-3 has a type the market does not know
    assert report["FP-1"].volume == "0.75 L" and report["FP-2"].volume == "40 units"
    assert all(r.predicted_price >= r.cost_per_unit * 1.3 - 0.01 for r in report.values())
    counts = {r.source: r.n for r in run.read("offers").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert counts == {"saco": 8, "mumzworld": 7}
    assert ids_of(run.store.current()) == ["FP-1", "FP-2"]
    assert run.row_counts["report"] == 2 and run.row_counts["page_offers"] == 24
    assert run.row_counts["volume_offers"] == 9 and run.row_counts["unit_offers"] == 7
    assert tuple(run.loss_products().first()) == (0, 2)
    run.export(str(tmp_path / "files"))
    exported = files.read_report(spark, str(tmp_path / "files/report")).collect()
    assert {r.product_id: r.predicted_price for r in exported} == {k: r.predicted_price for k, r in report.items()}
    assert files.read_volume_offers(spark, str(tmp_path / "files/volume_offers")).count() == 9
    assert files.read_unit_offers(spark, str(tmp_path / "files/unit_offers")).count() == 7

    assert run.run(landed(spark), "r2", dt.datetime(2025, 3, 2)) == "nothing new"
    assert run.run(landed(spark, new_product=True), "r3", dt.datetime(2025, 3, 10)) == "partial"
    assert ids_of(run.store.current()) == ["FP-1", "FP-2", "FP-4"] and ids_of(run.store.history()) == []
    assert run.read("offers").select("date").distinct().count() == 2

    assert run.run(landed(spark, new_product=True), "r4", dt.datetime(2025, 5, 1)) == "full"
    assert ids_of(run.store.history()) == ["FP-1", "FP-2", "FP-4"]
    assert ids_of(run.store.current()) == ["FP-1", "FP-2", "FP-4"]


def test_a_run_that_dies_may_be_repeated(spark, tmp_path, monkeypatch):
    run = PriceRun(spark, str(tmp_path), Settings(quote_year=2025, trees=3, max_depth=3))
    run.run(landed(spark), "r1", dt.datetime(2025, 3, 1))
    before = run.read("offers").count()
    with monkeypatch.context() as broken:
        broken.setattr(run, "_train", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run.run(landed(spark, new_product=True), "r2", dt.datetime(2025, 3, 10))
    counts = []
    for _ in range(2):
        assert run.run(landed(spark, new_product=True), "r2", dt.datetime(2025, 3, 10), "partial") == "partial"
        counts.append(run.read("offers").count())
    assert counts == [before + 8, before + 8]
    assert ids_of(run.store.current()) == ["FP-1", "FP-2", "FP-4"]


def test_pages_are_parsed_once_and_never_shuffled(spark, tmp_path, monkeypatch):
    from pricelens.operators import extract

    seen = []
    parse = extract.raw_fields
    monkeypatch.setattr(extract, "raw_fields", lambda pages, *a, **k: seen.append(parse(pages, *a, **k)) or seen[-1])
    run = PriceRun(spark, str(tmp_path), Settings(quote_year=2025, trees=3, max_depth=3))
    run.run(landed(spark), "r1", dt.datetime(2025, 3, 1))
    assert len(seen) == 1
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    assert run.row_counts["parsed_pages"] == 25


def test_own_score_is_near_a_hold_out(trained, spark):
    """Rows are scored by parts that never saw them; the score is that of a hold-out."""
    train, _ = trained
    model = forest.fit_forest(train, "volume_liters", "price_per_liter", trees=16)
    scored = forest.out_of_bag(model).collect()
    assert len(scored) == train.count() and {r.fold for r in scored} == set(range(forest.FOLDS))
    held = forest.holdout_score(train, "volume_liters", "price_per_liter", trees=16)
    assert forest.out_of_bag_score(model) == pytest.approx(held, abs=0.03)


def test_left_out_rows_do_not_change_their_part(spark):
    """A part's trees are the same whatever the labels of the rows it leaves out."""
    rows = [(i, float(i % 7 + 1), float(i % 7) * 3 + i % 3, 0.0, f"T{i % 3}", "Home", "B2C") for i in range(400)]
    schema = "id bigint, " + TRAIN.replace("price_per_liter double, approved", "price_per_liter double, approved")
    plain = spark.createDataFrame(rows, schema)
    fold = forest.fold_of(F.col("id"))
    changed = plain.withColumn("price_per_liter", F.when(fold == 0, 1e6).otherwise(F.col("price_per_liter")))
    prices = []
    for frame in (plain, changed):
        model = forest.fit_forest(frame, "volume_liters", "price_per_liter", trees=8, key="id")
        own = forest.out_of_bag(model).filter("fold = 0").select("key", "price").collect()
        prices.append({r.key: round(r.price, 9) for r in own})
    assert prices[0] == prices[1] and len(prices[0]) > 20


def test_leaf_table_equals_the_trees(spark, trained):
    """Mean and spread from the leaves' table are the trees' own; the leaf spread covers both."""
    _, path = trained
    model = forest.load_model(path)
    products = products_of(spark)
    by_leaf = {r.product_id: r for r in forest.with_leaf_stats(products, model).collect()}
    by_tree = forest.with_tree_spread(model.prepare.transform(products), model).collect()
    assert len(by_tree) == len(by_leaf) == 6
    for r in by_tree:
        own = by_leaf[r.product_id]
        assert own.tree_mean == pytest.approx(r.tree_mean, rel=1e-9)
        assert own.tree_spread == pytest.approx(r.tree_spread, abs=1e-6)
        assert own.leaf_spread >= own.tree_spread


def test_equal_rows_are_merged(spark):
    """However many rows are equal, few weighted ones are fitted, and the price is their mean."""
    rows = spark.range(20_000).selectExpr(
        "CAST(id % 2 + 1 AS DOUBLE) AS volume_liters", "CAST(id % 2 * 10 + id % 5 AS DOUBLE) AS price_per_liter",
        "0.0D AS approved_quote_price", "'T' AS type_of_product", "'H' AS subindustry", "'B' AS channel")
    model = forest.fit_forest(rows, "volume_liters", "price_per_liter", trees=8)
    priced = {r.volume_liters: r.unit_price for r in model.transform(rows.dropDuplicates(["volume_liters"])).collect()}
    assert priced[1.0] == pytest.approx(2.0, abs=0.2) and priced[2.0] == pytest.approx(12.0, abs=0.2)
    assert model.leaves.agg(F.sum("n")).first()[0] == pytest.approx(20_000 * 7, rel=0.02)


def test_rows_fitted_are_bounded_by_combinations(spark, monkeypatch):
    """Beyond a number of rows a part fits few weighted rows a combination; every row it may see counts."""
    monkeypatch.setattr(forest, "FITTED_ROWS", 600, raising=False)
    rows = spark.range(20_000).selectExpr(
        "CAST(id % 40 + 1 AS DOUBLE) AS volume_liters", "CAST(id % 40 * 10 + id % 7 AS DOUBLE) AS price_per_liter",
        "0.0D AS approved_quote_price", "concat('T', id % 5) AS type_of_product", "'H' AS subindustry",
        "'B' AS channel", "id")
    fitted, fit = [], forest.RandomForestRegressor.fit

    def recording(self, ready):
        fitted.append(ready.agg(F.count("*"), F.sum("weight")).first())
        return fit(self, ready)

    monkeypatch.setattr(forest.RandomForestRegressor, "fit", recording)
    model = forest.fit_forest(rows, "volume_liters", "price_per_liter", trees=8, key="id")
    assert len(fitted) == forest.FOLDS and max(n for n, _ in fitted) <= 600
    assert sum(weight for _, weight in fitted) == 20_000 * 7
    sums = model.leaves.groupBy("tree").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).agg(
        F.sum("n"), F.sum("total")).first()
    assert sums[0] == 20_000 * 7 and sums[1] == pytest.approx(
        7 * rows.agg(F.sum("price_per_liter")).first()[0], rel=1e-9)
    assert forest.out_of_bag(model).count() == 20_000 and forest.out_of_bag_score(model) > 0.9


def many_cells(spark, count=6000):
    return spark.range(count).selectExpr(
        "CAST(id % 30 + 1 AS DOUBLE) AS volume_liters",
        "CAST(id % 30 * 10 + id % 11 + id % 7 AS DOUBLE) AS price_per_liter",
        "0.0D AS approved_quote_price", "concat('T', id % 50) AS type_of_product", "'H' AS subindustry",
        "'B' AS channel", "id")


def prices_of(model, rows):
    asked = rows.dropDuplicates(["volume_liters", "type_of_product"])
    scored = forest.with_tree_spread(model.prepare.transform(asked), model)
    return {(r.volume_liters, r.type_of_product): (r.tree_mean, r.tree_spread) for r in scored.collect()}


def test_no_number_of_rows_changes_the_rule(spark, monkeypatch):
    """No bound on rows fitted makes other trees: every tree draws every row by itself, of many rows as of few."""
    rows = many_cells(spark)
    plain = prices_of(forest.fit_forest(rows, "volume_liters", "price_per_liter", trees=8, key="id"), rows)
    monkeypatch.setattr(forest, "FITTED_ROWS", 150, raising=False)
    bounded = prices_of(forest.fit_forest(rows, "volume_liters", "price_per_liter", trees=8, key="id"), rows)
    assert len(plain) == 150 and plain == bounded


def test_every_tree_draws_rows_one_by_one(spark):
    """Drawn counts and sums of a cell are those of its rows' own draws, however rows lie; own folds are not seen."""
    rows = [(cell, fold, float(cell * 10 + i % 9), cell * 1000 + 2 * i + fold)
            for cell in (3, 5) for fold in (0, 1) for i in range(400)]
    schema = "cell bigint, fold bigint, label double, number bigint"
    ordered = spark.createDataFrame(rows, schema).repartition(3).sortWithinPartitions("cell", "number")
    found = ordered.mapInArrow(growing.drawn([0, 5, 11]), growing.CELLS).collect()
    times = growing.times_drawn(np.array([r[3] for r in rows]), 11)
    assert 0.9 < times.mean() < 1.1 and 0.85 < times.var() < 1.15
    for cell, part, trees in ((c, p, t) for c in (3, 5) for p, t in ((0, range(5)), (1, range(5, 11)))):
        seen = [i for i, r in enumerate(rows) if r[0] == cell and r[1] != part]
        its = [r for r in found if (r.cell, r.part) == (cell, part)]
        labels = np.array([rows[i][2] for i in seen])
        assert sum(r.weight for r in its) == 400 and sum(r.total for r in its) == labels.sum()
        assert sum(r.squares for r in its) == (labels * labels).sum()
        for k, tree in enumerate(trees):
            assert sum(r.drawn[k] for r in its) == times[seen, tree].sum()
            assert sum(r.sums[k] for r in its) == (times[seen, tree] * labels).sum()


def test_trees_cut_as_a_slow_search_does():
    rng = np.random.default_rng(3)

    def slow(values, n, s, rows, depth, prices):
        count, total = n[rows].sum(), s[rows].sum()
        most, chosen = 1e-9, None
        for f, v in ((f, v) for f in range(5) for v in np.unique(values[f][rows])) if depth else ():
            side = values[f][rows] <= v if growing.ORDERED[f] else values[f][rows] == v
            a, b = rows[side], rows[~side]
            if min(n[a].sum(), n[b].sum()) >= 2:
                gain = s[a].sum() ** 2 / n[a].sum() + s[b].sum() ** 2 / n[b].sum() - total ** 2 / count
                if gain > most * (1 + 1e-9):
                    most, chosen = gain, (a, b)
        prices[rows] = total / count
        for side in chosen or ():
            slow(values, n, s, side, depth - 1, prices)

    for cells, depth in ((1, 5), (40, 0), (60, 3), (90, 30)):
        cell = np.unique(rng.integers(0, 6 * 5 * 4 * 3 * 7, cells))
        values = growing.features(cell, [6, 5, 4, 3, 7])
        n = rng.integers(1, 4, len(cell)).astype(float)
        s = n * rng.normal(50, 20, len(cell))
        *nodes, price = growing.grow(values, n, s, depth, 2)
        wanted = np.empty(len(cell))
        slow(values, n, s, np.arange(len(cell)), depth, wanted)
        assert price[growing.leaves_of(values, *nodes)] == pytest.approx(wanted)


def test_deep_trees_need_few_jobs(spark):
    """A part is grown by one job of a task for each tree, not by passes over the rows for every level."""
    rows = spark.range(3000).selectExpr(
        "CAST(id % 40 + 1 AS DOUBLE) AS volume_liters", "CAST(hash(id) % 1000 AS DOUBLE) AS price_per_liter",
        "0.0D AS approved_quote_price", "concat('T', id % 300) AS type_of_product", "'H' AS subindustry",
        "'B' AS channel", "id")
    spark.sparkContext.setJobGroup("deep", "a deep forest")
    try:
        model = forest.fit_forest(rows, "volume_liters", "price_per_liter", trees=8, key="id")
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("deep"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert model.leaves.groupBy("tree").count().agg(F.min("count")).first()[0] > 30
    assert jobs < 80


def test_spread_takes_time_in_proportion_to_the_trees(spark):
    """The mean is found once a row, not once more for every tree."""
    _, spread = forest.tree_stats(F.col("trees"))
    few = spark.createDataFrame([([1.0, 2.0, 6.0],)], "trees array<double>")
    assert few.select(spread.alias("s")).first().s == pytest.approx((14 / 3) ** 0.5)
    values = F.transform(F.sequence(F.lit(1), F.lit(4000)), lambda i: i * 1.0)
    many = spark.range(20, numPartitions=1).select(values.alias("trees"))
    began = time.perf_counter()
    assert many.agg(F.max(spread)).first()[0] == pytest.approx(4000 / 12 ** 0.5, rel=1e-6)
    assert time.perf_counter() - began < 10


def test_columns_of_no_type_come_back(spark, trained):
    _, path = trained
    products = products_of(spark).withColumn("nothing", F.lit(None))
    priced = forest.predict(products, path, "volume_liters")
    assert priced.columns[:len(products.columns)] == products.columns and priced.count() == 6
    assert dict(priced.dtypes)["nothing"] == "void"
