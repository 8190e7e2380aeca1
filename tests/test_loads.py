import shutil
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import Clock
from sources import D1, D2, D3, TABLES, source
from starmill.functions import labels
from starmill.operators.merge import AmbiguousSource
from starmill.plans import marts
from starmill.plans.audit import current_state, monitor, watermark_drift
from starmill.plans.facts import FACT_COLUMNS, DuplicateLines, load_fact
from starmill.plans.loads import Warehouse
from starmill.plans.quality import fact_duplicates, fact_orphans, reconciliation
from starmill.plans.facts import order_lines

ENTITIES = ["territory", "customer", "product", "salesperson", "promotion"]
DIMENSIONS = ["dim_territory", "dim_customer", "dim_product", "dim_salesperson", "dim_promotion"]


@pytest.fixture
def warehouse(spark, tmp_path, clock):
    ids = iter(range(10**6))
    return Warehouse(spark, str(tmp_path / "wh"), user="tester", clock=clock,
                     batch_ids=lambda: f"batch-{next(ids)}")


def run_all(warehouse, src, **sales):
    """Every load, dimensions before the fact."""
    warehouse.load_calendar()
    for entity in ENTITIES:
        warehouse.stage(entity, src)
    for name in DIMENSIONS:
        warehouse.load_dimension(name)
    warehouse.seed_unknown_salesperson()
    warehouse.load_sales(src, **sales)


@pytest.fixture(scope="module")
def loaded_folder(spark, tmp_path_factory):
    """A star loaded once from the small source system."""
    folder = str(tmp_path_factory.mktemp("star") / "wh")
    run_all(Warehouse(spark, folder, user="tester", clock=Clock()), source(spark))
    return folder


@pytest.fixture
def loaded(spark, loaded_folder, tmp_path):
    """A copy of the loaded star that a test may change."""
    folder = str(tmp_path / "copy")
    shutil.copytree(loaded_folder, folder)
    ids = iter(range(10**6))
    return Warehouse(spark, folder, user="tester", clock=Clock(datetime(2024, 3, 1)),
                     batch_ids=lambda: f"later-{next(ids)}")


def state_of(warehouse, process):
    return current_state(warehouse.log.read()).where(F.col("process") == process).first()


# -- staging -----------------------------------------------------------------------------------

def test_customer_extract(spark, warehouse, rows):
    warehouse.stage("customer", source(spark))
    staged = warehouse.staged("customer")
    assert rows(staged, "customer_id", "person_id", "customer_type", "full_name", "email", "phone", "city",
                "state_province", "country", "territory_id") == [
        (1, 11, "PERSONA", "Ana Ruiz", "new@x.org", "111", "Cuenca", "Azuay", "Ecuador", 1),
        (2, None, "EMPRESA", " ", None, None, None, None, None, 2),
        (3, 13, "PERSONA", " X", None, None, None, None, None, 1)]
    assert rows(staged.select("batch_id").distinct()) == [("batch-0",)]


def test_product_labels(spark, warehouse, rows):
    warehouse.stage("product", source(spark))
    assert rows(warehouse.staged("product"), "product_id", "color", "subcategory", "category") == [
        (101, "Red", "Road Bikes", "Bikes"), (102, "N/A", "Sin SubCategoria", "Sin Categoria")]


def test_salesperson_extract_keeps_those_without_a_territory(spark, warehouse, rows):
    warehouse.stage("salesperson", source(spark))
    assert rows(warehouse.staged("salesperson"), "salesperson_id", "full_name", "job_title", "territory_id",
                "territory_name") == [
        (21, "Luis Paz", "Rep", 1, "Andes"), (22, "Eva ", None, None, None)]


def test_discount_keeps_four_decimals(spark, warehouse, rows):
    warehouse.stage("promotion", source(spark))
    staged = warehouse.staged("promotion")
    assert rows(staged, "promotion_id", "discount_pct") == [(1, Decimal("0.0000")), (2, Decimal("0.0150"))]
    narrowed = staged.where("promotion_id = 2").select(F.col("discount_pct").cast("decimal(5,2)"))
    assert narrowed.first()[0] == Decimal("0.02")


def test_second_run_stages_only_newer_rows(spark, warehouse, rows):
    warehouse.stage("product", source(spark))
    assert warehouse.log.last_watermark(labels.STG_PRODUCT) == D2  # its own newest row, not another table's
    changed = [*TABLES["product"][1], (103, "New", None, None, None, None, None, None, None, None, None, D3)]
    warehouse.stage("product", source(spark, product=changed))
    assert rows(warehouse.staged("product"), "product_id") == [(103,)]
    assert warehouse.log.last_watermark(labels.STG_PRODUCT) == D3


def test_lookback_stages_late_rows(spark, warehouse, rows):
    warehouse.stage("product", source(spark))
    late = [*TABLES["product"][1], (103, "Late", None, None, None, None, None, None, None, None, None,
                                    D2 - timedelta(hours=1))]
    warehouse.stage("product", source(spark, product=late), lookback=timedelta(days=1))
    assert rows(warehouse.staged("product"), "product_id") == [(102,), (103,)]
    assert warehouse.log.last_watermark(labels.STG_PRODUCT) == D2


def test_empty_batch(spark, warehouse):
    warehouse.stage("customer", source(spark))
    warehouse.stage("customer", source(spark))
    state = state_of(warehouse, labels.STG_CUSTOMER)
    assert warehouse.staged("customer").count() == 0
    assert state.state == "OK" and state.watermark == D2 and state.rows_affected == 0


def test_failed_load_is_logged_raised_and_leaves_staging(spark, warehouse):
    warehouse.stage("product", source(spark))
    broken = source(spark)
    broken["product_category"] = broken["product_category"].drop("name")
    with pytest.raises(Exception):
        warehouse.stage("product", broken)
    state = state_of(warehouse, labels.STG_PRODUCT)
    assert state.state == "ERROR" and "name" in state.message and state.ended_at is not None
    assert warehouse.staged("product").count() == 2
    assert warehouse.log.last_watermark(labels.STG_PRODUCT) == D2


def test_failure_while_writing_leaves_staging(spark, warehouse):
    warehouse.stage("product", source(spark))
    broken = source(spark)
    broken["product"] = broken["product"].withColumns({
        "modified_date": F.lit(D3).cast("timestamp_ntz"),
        "list_price": F.raise_error(F.lit("source lost")).cast("decimal(10,2)")})
    with pytest.raises(Exception, match="source lost"):
        warehouse.stage("product", broken)
    assert warehouse.staged("product").count() == 2
    assert state_of(warehouse, labels.STG_PRODUCT).state == "ERROR"


# -- dimensions --------------------------------------------------------------------------------

def test_dimension_loads_and_unknown_member(spark, loaded, rows):
    people = loaded.dimension("dim_salesperson")
    assert rows(people, "salesperson_key", "salesperson_id_source", "full_name", "job_title") == [
        (-1, -1, "VENTA POR INTERNET / SIN VENDEDOR", "N/A"), (1, 21, "Luis Paz", "Rep"),
        (2, 22, "Eva ", "Sin carga")]
    assert rows(loaded.dimension("dim_territory"), "territory_key", "territory_name", "country",
                "group_name") == [(1, "Andes", "Ecuador", "America"), (2, "Sin Nombre", "Sin Pais", "Sin Grupo")]


def test_second_load_updates_inserts_and_keeps_keys(spark, loaded, rows):
    first = {r.salesperson_id_source: r for r in loaded.dimension("dim_salesperson").collect()}
    people = [(21, 1, None, None, None, D1), (22, 1, None, None, None, D3), (24, None, None, None, None, D3)]
    employees = [*TABLES["employee"][1], (24, "Boss", None)]
    persons = [*TABLES["person"][1], (24, "Noa", "Gil")]
    loaded.stage("salesperson", source(spark, sales_person=people, employee=employees, person=persons))
    loaded.load_dimension("dim_salesperson")
    second = {r.salesperson_id_source: r for r in loaded.dimension("dim_salesperson").collect()}
    assert second[21] == first[21] and second[-1] == first[-1]
    assert second[22].territory_id_source == 1 and second[22].salesperson_key == first[22].salesperson_key
    assert second[22].loaded_at > first[22].loaded_at
    assert second[24].salesperson_key == 3
    assert state_of(loaded, labels.DW_SALESPERSON).rows_affected == 2


def test_gained_territory_is_missed_by_the_plain_comparison(spark, loaded):
    loaded.stage("salesperson", source(spark, sales_person=[(22, 1, None, None, None, D3)]))
    loaded.load_dimension("dim_salesperson", null_safe=False)
    eva = loaded.dimension("dim_salesperson").where("salesperson_id_source = 22").first()
    assert eva.territory_id_source is None


def test_loading_again_changes_nothing(spark, loaded, rows):
    before = {n: rows(loaded.dimension(n)) for n in DIMENSIONS}
    for entity in ENTITIES:
        loaded.stage(entity, source(spark))
    for name in DIMENSIONS:
        loaded.load_dimension(name)
    assert {n: rows(loaded.dimension(n)) for n in DIMENSIONS} == before


def test_ambiguous_batch_is_refused(spark, warehouse):
    twice = [(1, "None", Decimal("0"), "A", "No", None, None, 0, None, D1),
             (1, "Other", Decimal("0"), "A", "No", None, None, 0, None, D1)]
    warehouse.stage("promotion", source(spark, special_offer=twice))
    with pytest.raises(AmbiguousSource):
        warehouse.load_dimension("dim_promotion")
    assert state_of(warehouse, labels.DW_PROMOTION).state == "ERROR"


# -- fact --------------------------------------------------------------------------------------

def test_fact_rows(spark, loaded, rows):
    fact = loaded.sales()
    # the line of an unknown product is dropped, the web order keeps its place with key -1
    assert rows(fact, "sales_order_id", "product_key", "customer_key", "salesperson_key", "date_key") == [
        (1001, 1, 1, 1, 20140101), (1001, 2, 1, 1, 20140101), (1002, 1, 2, -1, 20140601),
        (1003, 2, 3, 2, 20141231)]
    assert fact.columns == [*FACT_COLUMNS, "order_year"]


def test_unknown_policy_for_a_missing_product(spark, loaded, rows):
    loaded.load_sales(source(spark), on_missing={"dim_product": "unknown"})
    assert (1003, -1) in rows(loaded.sales(), "sales_order_id", "product_key")
    assert loaded.sales().count() == 5


def test_fact_load_twice_adds_nothing(spark, loaded, rows):
    before = rows(loaded.sales())
    loaded.load_sales(source(spark))
    assert rows(loaded.sales()) == before
    assert state_of(loaded, labels.DW_SALES).rows_affected == 0


def test_new_lines_are_appended(spark, loaded, rows):
    heads = [*TABLES["sales_order_header"][1], (1004, datetime(2015, 1, 5), 1, 21, 1)]
    lines = [*TABLES["sales_order_detail"][1],
             (1004, 101, 1, 1, Decimal("100"), Decimal("0"), Decimal("100"))]
    changed = source(spark, sales_order_header=heads, sales_order_detail=lines)
    loaded.load_sales(changed, since=datetime(2015, 1, 1))
    assert rows(loaded.sales().where("order_year = 2015"), "sales_order_id", "date_key") == [(1004, 20150105)]
    assert loaded.sales().count() == 5
    loaded.load_sales(changed, since=datetime(2014, 6, 1))
    assert loaded.sales().count() == 5


def test_duplicate_lines(spark, loaded, rows):
    dims = loaded.dimensions()
    twice = [*TABLES["sales_order_detail"][1],
             (1001, 101, 1, 9, Decimal("1"), Decimal("0"), Decimal("9"))]
    src = source(spark, sales_order_detail=twice)
    detail, header = src["sales_order_detail"], src["sales_order_header"]
    with pytest.raises(DuplicateLines):
        load_fact(detail, header, dims, duplicates="error")
    first = load_fact(detail, header, dims, duplicates="first", line_order=["order_qty"])
    assert rows(first.where("sales_order_id = 1001 and product_key = 1"), "order_qty") == [(1,)]
    assert load_fact(detail, header, dims).count() == 5
    assert rows(fact_duplicates(detail, ["sales_order_id", "product_id"])) == [(1001, 101, 2)]


def test_quality_reports(spark, loaded, rows):
    src, dims = source(spark), loaded.dimensions()
    lines = order_lines(src["sales_order_detail"], src["sales_order_header"])
    assert dict(rows(fact_orphans(lines, dims)))["dim_product"] == 1
    assert sum(n for _, n in rows(fact_orphans(lines, dims))) == 1
    assert rows(reconciliation(src["sales_order_detail"], src["sales_order_header"], dims)) == [
        ("dropped: dim_product", 1), ("loaded", 4), ("source", 5)]
    headless = src["sales_order_header"].where("sales_order_id <> 1001")
    assert dict(rows(reconciliation(src["sales_order_detail"], headless, dims))) == {
        "dropped: order header": 2, "dropped: dim_product": 1, "loaded": 2, "source": 5}


def test_history_dimension_places_sales_in_the_territory_of_their_time(spark, warehouse, rows):
    moves = [[(21, 1, None, None, None, D1)], [(21, 2, None, None, None, D2)]]
    for people in moves:
        warehouse.stage("salesperson", source(spark, sales_person=people))
        warehouse.load_history("dim_salesperson")
    history = warehouse.history("dim_salesperson")
    assert rows(history, "salesperson_id_source", "territory_id_source", "valid_from", "valid_to",
                "is_current", "version") == [(21, 1, D1, D2, False, 1), (21, 2, D2, None, True, 2)]
    heads = [(1, D1, 1, 21, 1), (2, D2 - timedelta(days=1), 1, 21, 1), (3, D2, 1, 21, 1), (4, D3, 1, None, 1)]
    lines = [(o, 101, 1, 1, Decimal("1"), Decimal("0"), Decimal(o)) for o in (1, 2, 3, 4)]
    src = source(spark, sales_order_header=heads, sales_order_detail=lines)
    sold = order_lines(src["sales_order_detail"], src["sales_order_header"]).withColumnRenamed(
        "sales_person_id", "salesperson_id_source")
    found = marts.sales_at_time_of_sale(sold, history, "salesperson_id_source", "order_date",
                                        "territory_id_source")
    assert rows(found) == [(1, 2, Decimal("3.00")), (2, 1, Decimal("3.00")), (None, 1, Decimal("4.00"))]


# -- marts and audit ---------------------------------------------------------------------------

def test_star_answers_like_the_source(spark, loaded, rows):
    src = source(spark)
    assert rows(marts.territory_category(loaded.star())) == rows(marts.territory_category_from_sources(src))


def test_kpis(spark, loaded, rows):
    star = loaded.star()
    assert rows(marts.totals(star["fact_sales"])) == [(Decimal("324.60"), 28)]
    assert rows(marts.average_ticket(star["fact_sales"])) == [
        (Decimal("324.60"), 3, Decimal("108.200000"))]
    assert rows(marts.salesperson_rank(star), "sales_rank", "full_name") == [
        (1, "VENTA POR INTERNET / SIN VENDEDOR"), (2, "Luis Paz"), (3, "Eva ")]
    assert rows(marts.sliced_totals(star, 2014, "Bikes", "America")) == [(Decimal("100.00"), 1, 1)]
    assert rows(marts.monthly_with_mean(star))[0] == (2014, 1, Decimal("119.60"), Decimal("108.200000"))


def test_growth_needs_the_year_before(spark, rows):
    fact = spark.createDataFrame([(20100101, Decimal("100")), (20110101, Decimal("150")),
                                  (20130101, Decimal("90"))], "date_key int, line_total decimal(12,2)")
    days = spark.createDataFrame([(20100101, 2010), (20110101, 2011), (20130101, 2013)],
                                 "date_key int, year int")
    growth = marts.yoy_growth({"fact_sales": fact, "dim_date": days})
    assert rows(growth) == [
        (2010, Decimal("100.00"), None, None), (2011, Decimal("150.00"), Decimal("100.00"), Decimal("0.500000")),
        (2013, Decimal("90.00"), None, None)]


def test_a_run_in_progress_has_no_duration(spark, warehouse, rows):
    warehouse.stage("product", source(spark))
    warehouse.log.start(labels.STG_PRODUCT, "later", warehouse.clock() + timedelta(hours=1))
    row = monitor(warehouse.log.read()).first()
    assert (row.state, row.ended_at, row.seconds) == ("EN PROCESO", None, None)
    assert row.watermark == D2  # the stored watermark stays visible while the run goes on


def test_monitor_and_drift(spark, loaded, rows):
    shown = monitor(loaded.log.read()).collect()
    assert len(shown) == 11 and all(r.state == "OK" and r.seconds >= 1 for r in shown)
    assert [r.started_at for r in shown] == sorted((r.started_at for r in shown), reverse=True)
    drift = dict((r.process, r.seconds_behind) for r in watermark_drift(loaded.log.read()).collect())
    assert drift[labels.STG_CUSTOMER] == 0
    assert drift[labels.STG_TERRITORY] == (D2 - D1).total_seconds()
