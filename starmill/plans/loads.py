"""The loads: source to staging, staging to dimension, lines to fact.

Each load logs its start, does its work from snapshots to a new snapshot, and logs the outcome.
A failure is logged and raised again; the snapshot before it stays current.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmill.functions import labels
from starmill.functions.calendar import calendar
from starmill.functions.scalars import time_literal
from starmill.operators.incremental import tag_batch
from starmill.operators.figures import Figures
from starmill.operators.history import scd2_keyed
from starmill.operators.keys import max_key, with_unknown_member
from starmill.operators.lookup import one_per_key
from starmill.operators.merge import BROADCAST_BYTES, count_unambiguous
from starmill.plans.audit import RunLog
from starmill.plans.dimensions import DIMENSIONS, UNKNOWN_SALESPERSON, inferred_members, merge_dimension
from starmill.plans.extracts import DRIVING, EXTRACTS, Sources, followed
from starmill.plans.facts import (
    FACT_KEY, LINE_KEY, LOOKUPS, MEASURES, VERSION_KEY, Lookup, header_keys, lookups_with, new_lines, order_lines, with_keys,
    without_place)
from starmill.plans.quality import duplicates_with, fact_key_orphans
from starmill.schemas import (
    DUPLICATES, MERGED, ORPHANS, SOURCE_MARKS, STAGING, STORED_FACT, WAITING_ORDERS, WAREHOUSE)
from starmill.sources.shared import Scratch
from starmill.sources.store import BUCKET, Store, bucket_of
from starmill.sources.tables import OpenOnUse

# Orders are looked at again for so long, for lines that reach the source late.
SALES_LOOKBACK = timedelta(days=7)

STAGING_PROCESS = {
    "customer": labels.STG_CUSTOMER,
    "product": labels.STG_PRODUCT,
    "promotion": labels.STG_PROMOTION,
    "salesperson": labels.STG_SALESPERSON,
    "territory": labels.STG_TERRITORY,
}


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class _Run:
    """What a load reports when it ends."""

    def __init__(self, batch_id: str):
        self.batch_id = batch_id
        self.rows = 0
        self.watermark: datetime | None = None


class Warehouse:
    """A star kept in a store. ``clock``, ``batch_ids`` and ``user`` are injectable for tests.

    ``user`` is the session's user unless given. ``histories`` declares the dimensions that have a type 2
    history: a staged batch is kept until the dimension and its declared history have taken it in. Without a
    declaration any dimension may get a history at any time, and batches are kept for it. ``buckets`` names
    large dimensions and into how many parts, by hash of the business id, each is cut; a load rewrites only
    the parts that its batch touches.
    """

    def __init__(self, spark: SparkSession, root: str, user: str | None = None,
                 clock: Callable[[], datetime] = _utc_now,
                 batch_ids: Callable[[], str] = lambda: str(uuid.uuid4()),
                 histories: Sequence[str] | None = None, buckets: Mapping[str, int] | None = None):
        self.spark, self.clock, self.batch_ids = spark, clock, batch_ids
        self.user = spark.sparkContext.sparkUser() if user is None else user
        self.histories, self.buckets = histories, dict(buckets or {})
        self.store = Store(spark, root)
        self.log = RunLog(self.store)

    @contextmanager
    def _run(self, process: str) -> Iterator[_Run]:
        run, started = _Run(self.batch_ids()), self.clock()
        self.log.start(process, run.batch_id, started)
        try:
            yield run
        except Exception as error:
            self.log.failure(process, run.batch_id, started, self.clock(), str(error))
            raise
        self.log.success(process, run.batch_id, started, self.clock(), run.rows, run.watermark)

    # -- staging ---------------------------------------------------------------------------

    def stage(self, entity: str, src: Sources, lookback: timedelta = timedelta(0), follow: bool = False) -> None:
        """Replace the staging table of ``entity`` with the rows modified since the last run.

        With ``follow`` also the members that changes of joined tables touch. Each table is followed up to
        its own watermark, which is read before the extract: a row that arrives meanwhile is staged twice
        rather than never.
        """
        process, table, schema = STAGING_PROCESS[entity], f"stg/{entity}", STAGING[entity]
        with self._run(process) as run:
            last = self.log.last_watermark(process)
            changed, marks = None, {}
            if follow:
                marks = self._newest(entity, src)
                known = {} if last == labels.FIRST_WATERMARK else self._marks(entity)
                # A first load takes every member anyway.
                changed = {} if last == labels.FIRST_WATERMARK else {
                    t: known.get(t, labels.FIRST_WATERMARK) for t in marks if t != DRIVING[entity]}
            staged = tag_batch(EXTRACTS[entity](src, last, lookback, changed), run.batch_id, self.clock())
            written = Figures(conform(staged, schema), count=F.count(F.lit(1)),
                               newest=F.max("modified_date").cast("string"))
            self.store.write(table, written.rows)
            run.rows, newest = written.count, written["newest"]
            run.watermark = max(last, datetime.fromisoformat(newest)) if newest else last
            if follow:
                run.watermark = max(last, marks.pop(DRIVING[entity]) or last)
                self._set_marks(entity, {t: m for t, m in marks.items() if m is not None})

    def _newest(self, entity: str, src: Sources) -> dict[str, datetime | None]:
        """Newest modification time of the driving table and of each joined table that tells one."""
        names = [DRIVING[entity], *[f.table for f in followed(entity, src)]]
        newest = [src[n].agg(F.max("modified_date").alias("newest")).select(F.lit(n).alias("source"), "newest")
                  for n in names]
        return dict(map(tuple, reduce(DataFrame.union, newest).collect()))

    def _marks(self, name: str) -> dict[str, datetime]:
        return dict(map(tuple, self.store.read(f"etl/sources/{name}", SOURCE_MARKS).collect()))

    def _set_marks(self, name: str, marks: Mapping[str, datetime]) -> None:
        marks = {**self._marks(name), **marks}
        self.store.write(f"etl/sources/{name}", self.spark.createDataFrame(sorted(marks.items()), SOURCE_MARKS))
        self.store.prune(f"etl/sources/{name}", keep=1)

    def staged(self, entity: str) -> DataFrame:
        return self.store.read(f"stg/{entity}", STAGING[entity])

    def _merged(self, table: str) -> int:
        """The staging version that ``table`` has last taken in."""
        notes = self.store.read(f"etl/merged/{table}", MERGED)
        return notes.agg(F.max("version")).first()[0] or 0

    def _pending(self, entity: str, table: str) -> tuple[DataFrame, int]:
        """Staged rows that ``table`` has not taken in yet, with their ``_version``, and the newest of these.

        A batch stays pending until a load has written its result, however many are staged meanwhile.
        """
        merged, staging = self._merged(table), f"stg/{entity}"
        newer = [v for v in self.store.versions(staging) if v > merged]
        batches = [self.store.read(staging, STAGING[entity], version=v).withColumn("_version", F.lit(v))
                   for v in newer]
        nothing = self.spark.createDataFrame([], STAGING[entity]).withColumn("_version", F.lit(merged))
        return reduce(DataFrame.unionByName, batches, nothing), max(newer, default=merged)

    def _note_merged(self, entity: str, table: str, version: int) -> None:
        """Taken in up to ``version``; staging versions that every reader has taken in are dropped."""
        notes = f"etl/merged/{table}"
        self.store.write(notes, self.spark.range(version, version + 1, numPartitions=1).toDF("version"))
        self.store.prune(notes, keep=1)
        self.store.prune(table)
        names = [n for n, d in DIMENSIONS.items() if d.staging == entity]
        readers = [f"dw/{n}" for n in names] + [
            f"dw/{n}_history" for n in names if self.histories is None or n in self.histories]
        taken = min(self._merged(t) for t in readers)
        self.store.prune(f"stg/{entity}", keep=1, up_to=taken)

    # -- dimensions ------------------------------------------------------------------------

    def load_calendar(self, start: date = date(2000, 1, 1), end: date = date(2030, 12, 31)) -> None:
        self.store.write("dw/dim_date", calendar(self.spark, start, end).coalesce(1))

    def load_dimension(self, name: str, null_safe: bool = True, collation: str | None = None) -> None:
        """Merge the batches staged since the last merge into the dimension and write its next snapshot.

        Of a member staged by several batches the last one counts. Of a dimension in ``buckets`` only the
        buckets with staged members are read and rewritten. Inserted and updated rows are counted by the
        write itself.
        """
        dim, schema, table = DIMENSIONS[name], WAREHOUSE[name], f"dw/{name}"
        with self._run(dim.process) as run, Scratch(self.spark, name) as scratch:
            pending, version = self._pending(dim.staging, table)
            staged = dim.source(pending, "_version")
            members = count_unambiguous(staged, [dim.staged_id, "_version"])
            if members == 0 and self.store.exists(table):
                self._note_merged(dim.staging, table, version)
                return
            source = one_per_key(staged, [dim.staged_id], ["_version"]).drop("_version")
            source, size = scratch.sized_table(source)
            if name in self.buckets:
                bucket = bucket_of([dim.staged_id], self.buckets[name])
                touched = [r[0] for r in source.select(bucket).distinct().collect()]
                target = self.store.read_buckets(table, schema, touched).drop(BUCKET)
            else:
                target = self.dimension(name)
            merged = merge_dimension(
                dim, target, source, {"loaded_at": self.clock(), "load_user": self.user}, scratch,
                null_safe=null_safe, collation=collation, broadcast_source=size <= BROADCAST_BYTES,
                last_key=max_key(self.dimension(name), dim.key))
            written = Figures(merged, count=F.count_if(F.col("action") != "keep"))
            merged = conform(written.rows, schema)
            if name in self.buckets:
                self.store.replace_buckets(
                    table, merged.withColumn(BUCKET, bucket_of([dim.business_id], self.buckets[name])))
            else:
                self.store.write(table, merged)
            run.rows = written.count
            self._note_merged(dim.staging, table, version)

    def _add_members(self, name: str, rows: DataFrame) -> None:
        """Write ``rows`` into a dimension; of a dimension in buckets only theirs are rewritten."""
        if name in self.buckets:
            rows = rows.withColumn(BUCKET, bucket_of([DIMENSIONS[name].business_id], self.buckets[name]))
            touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
            self.store.replace_buckets(f"dw/{name}", self.store.read_buckets(
                f"dw/{name}", WAREHOUSE[name], touched).unionByName(rows))
        else:
            self.store.write(f"dw/{name}", self.dimension(name).unionByName(rows))
            self.store.prune(f"dw/{name}")

    def load_history(self, name: str) -> None:
        """Add the batches staged since the last time to the type 2 history of a dimension.

        A member's attributes are taken to hold from its modification time on. The history is
        kept beside the type 1 dimension, under its name with ``_history`` added; every version has a key of
        its own, ``version_key``, which it keeps whatever arrives later.
        """
        if self.histories is not None and name not in self.histories:
            raise ValueError(f"{name} is not declared among the histories, so its batches may be gone")
        dim, table = DIMENSIONS[name], f"dw/{name}_history"
        with self._run(f"{dim.process}_HISTORY") as run, Scratch(self.spark, name) as scratch:
            pending, version = self._pending(dim.staging, table)
            if count_unambiguous(dim.source(pending, "_version"), [dim.staged_id, "_version"]) == 0 and self.store.exists(table):
                self._note_merged(dim.staging, table, version)
                return
            # Two batches may hold two states of one time; the later batch tells.
            taken = Figures(dim.observations(pending, "_version"), count=F.count(F.lit(1)))
            observed = scratch.table(taken.rows)
            run.rows = taken.count
            history = self.store.read(table) if self.store.exists(table) else None
            self.store.write(table, scd2_keyed(
                history, observed, [dim.business_id], "modified_date", list(dim.attributes), VERSION_KEY,
                tie=["_version"], scratch=scratch))
            self._note_merged(dim.staging, table, version)

    def history(self, name: str) -> DataFrame:
        return self.store.read(f"dw/{name}_history").drop("_version")

    def versions(self, name: str) -> DataFrame:
        """The type 2 dimension as facts loaded with its version keys refer to it: under the dimension's key
        column, with the unknown member."""
        dim = DIMENSIONS[name]
        unknown = self.dimension(name).where(F.col(dim.key) == labels.UNKNOWN_KEY).select(
            dim.key, dim.business_id, *dim.attributes)
        return self.history(name).withColumnRenamed(VERSION_KEY, dim.key).unionByName(
            unknown, allowMissingColumns=True)

    def seed_unknown_salesperson(self) -> None:
        """Add the member that stands for sales without a salesperson; needed once."""
        name = "dim_salesperson"
        current = self.dimension(name)
        if current.where(F.col("salesperson_key") == labels.UNKNOWN_KEY).isEmpty():
            self._add_members(name, with_unknown_member(self.spark.createDataFrame([], WAREHOUSE[name]), {
                **UNKNOWN_SALESPERSON, "loaded_at": self.clock(), "load_user": self.user}))

    def dimension(self, name: str) -> DataFrame:
        if name == "dim_date":
            return self.store.read("dw/dim_date")
        if name in self.buckets:
            return self.store.read_buckets(f"dw/{name}", WAREHOUSE[name]).drop(BUCKET)
        return self.store.read(f"dw/{name}", WAREHOUSE[name])

    # -- fact ------------------------------------------------------------------------------

    def load_sales(self, src: Sources, *, since: datetime | None = None,
                   lookback: timedelta = SALES_LOOKBACK, full: bool = False,
                   duplicates: str = "error", line_order=(),
                   sales_person: Column | None = None,
                   on_missing: Mapping[str, str] | None = None,
                   versions: Sequence[str] = ()) -> None:
        """Append the lines the fact does not hold yet.

        The first load takes all orders, later ones those dated after the watermark of the last load less
        ``lookback``, or from ``since`` on, and orders that still wait for a member one of their lines was
        dropped for; ``full`` takes all again. Stored lines are compared for the years and orders of the
        batch only.

        ``on_missing`` overrides what a lookup without a match means: ``drop`` the line, use the
        ``unknown`` member, or ``infer`` a member, a placeholder with a key of its own that a later load
        of the dimension fills in. Dimensions in ``versions`` are looked up in their type 2 history by the
        order's date.
        """
        with self._run(labels.DW_SALES) as run, Scratch(self.spark, "sales") as scratch:
            detail, header, known = src["sales_order_detail"], src["sales_order_header"], self._stored_sales()
            newest = header.agg(F.max("order_date")).first()[0]
            last = self._marks("sales").get("sales_order_header")
            waiting = self.store.read("etl/waiting/sales", WAITING_ORDERS)
            if since is not None or last is not None and not full:
                recent = F.col("order_date") >= time_literal(since) if since is not None \
                    else F.col("order_date") > time_literal(last - lookback)
                late = header.where(recent.isNull() | ~recent).join(waiting, "sales_order_id", "left_semi")
                header = scratch.table(header.where(recent).unionByName(late))
                orders = header.select("sales_order_id")
                detail = detail.join(orders, "sales_order_id", "left_semi")
                # One value per year of the batch: the stored lines of other years are not read.
                years = [r[0] for r in header.select(F.year("order_date")).distinct().collect()]
                known = known.where(F.col("order_year").isin(years)).join(orders, "sales_order_id", "left_semi")
            lookups = lookups_with(on_missing)
            left, dims = dict(lookups), self.dimensions()
            header = header_keys(header, dims, left, versions, drop=False)
            keys = [l.key for n, l in lookups.items() if n not in left]
            lines = order_lines(new_lines(detail, known if self.store.exists("dw/fact_sales") else None,
                                          duplicates, line_order), header, sales_person)
            wanted = dict.fromkeys([*LINE_KEY, *[l.line_column for l in LOOKUPS], "order_date", *MEASURES, *keys])
            taken = Figures(lines.select(*wanted), count=F.count(F.lit(1)))
            lines = scratch.table(taken.rows)
            for lookup in lookups.values():
                if lookup.on_missing == "infer":
                    self._infer(lookup, lines, scratch)
            dims = self.dimensions()
            found = lines.dropna(subset=keys) if keys else lines
            rows = with_keys(found, dims, list(left.values()),
                             {n: self.history(n) for n in versions}, scratch)
            rows = conform(rows.withColumns({"order_year": order_year(), "product_id_source": F.col("product_id")}),
                           STORED_FACT)
            # Each task writes a file per year it holds; a shuffle by year would move every line once more.
            written = Figures(rows, count=F.count(F.lit(1)))
            self.store.append("dw/fact_sales", written.rows, run.batch_id, partition_by=["order_year"])
            run.rows = written.count
            self._note_waiting(lines, dims, list(lookups.values()), taken.count > run.rows)
            if newest is not None and since is None:
                self._set_marks("sales", {"sales_order_header": max(newest, last or newest)})

    def _infer(self, lookup: Lookup, lines: DataFrame, scratch: Scratch) -> None:
        """Give every business id of ``lines`` that its dimension lacks a placeholder member."""
        dim, current = DIMENSIONS[lookup.dimension], self.dimension(lookup.dimension)
        ids = lines.select(F.col(lookup.line_column).alias("_id")).where("_id IS NOT NULL").distinct()
        unknown = scratch.table(ids.join(current, ids["_id"] == current[dim.business_id], "left_anti"))
        if not unknown.isEmpty():
            stamps = {"loaded_at": self.clock().isoformat(sep=" "), "load_user": self.user}
            self._add_members(lookup.dimension, scratch.table(inferred_members(
                dim, unknown, current, stamps, max_key(current, dim.key), scratch)))

    def _note_waiting(self, lines: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup],
                      some: bool) -> None:
        """Orders with dropped lines, which the next load looks at again."""
        table = "etl/waiting/sales"
        if some:
            self.store.write(table, conform(without_place(lines, dims, lookups), WAITING_ORDERS))
        elif self.store.exists(table):
            self.store.write(table, self.spark.createDataFrame([], WAITING_ORDERS))
        self.store.prune(table, keep=1)

    def dimensions(self) -> Mapping[str, DataFrame]:
        return OpenOnUse({l.dimension: partial(self.dimension, l.dimension) for l in LOOKUPS})

    def _stored_sales(self) -> DataFrame:
        return self.store.read("dw/fact_sales", STORED_FACT)

    def sales(self) -> DataFrame:
        return self._stored_sales().drop("product_id_source")

    def star(self, versions: Sequence[str] = ()) -> Mapping[str, DataFrame]:
        """The fact and its dimensions; those in ``versions`` as type 2, for a fact loaded with their keys."""
        return OpenOnUse({**{l.dimension: partial(self.versions if l.dimension in versions else self.dimension, l.dimension)
                             for l in LOOKUPS},
                          "fact_sales": self.sales})

    # -- checks ----------------------------------------------------------------------------

    def check_sales(self, dims: Mapping[str, DataFrame] | None = None) -> None:
        """Check the parts of the stored fact that have not been checked yet, each once.

        A part is checked against the dimensions and against the lines of its own orders and years in the
        parts before it; the results are stored under the part's name.
        """
        dims = dims or self.dimensions()
        checked = self.store.parts("dq/duplicates")
        for part in [p for p in self.store.parts("dw/fact_sales") if p not in checked]:
            rows = self.store.read("dw/fact_sales", STORED_FACT, parts=[part])
            earlier = self.store.read("dw/fact_sales", STORED_FACT, parts=checked)
            self.store.append("dq/orphans", conform(fact_key_orphans(rows, dims), ORPHANS), part)
            self.store.append("dq/duplicates", conform(duplicates_with(rows, earlier, FACT_KEY), DUPLICATES), part)
            checked.append(part)

    def orphans(self) -> DataFrame:
        """Stored lines whose key a dimension does not hold, per dimension, by the checks made so far."""
        return self.store.read("dq/orphans", ORPHANS).groupBy("dimension").agg(F.sum("rows").alias("rows"))

    def duplicates(self) -> DataFrame:
        """Order and product keys stored more than once, by the checks made so far."""
        return self.store.read("dq/duplicates", DUPLICATES).groupBy(*FACT_KEY).agg(F.max("rows").alias("rows"))


def order_year() -> Column:
    return F.floor(F.col("date_key") / 10000).cast("int")


def conform(df: DataFrame, schema) -> DataFrame:
    """Columns and types of ``schema``, in its order."""
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                           for f in schema.fields])
