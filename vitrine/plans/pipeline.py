"""The batch pipeline: ingest -> checks -> dimensions -> facts -> aggregate.

Each step reads tables, runs one job function from ``vitrine.operators`` and
writes its result (append or new snapshot), logging input/output/rejected
counts. A step that fails is logged FAILED with its message and stops the run;
the batch is closed FAILED. Re-running a batch is safe: facts skip rows
already loaded, dimensions are upserts, the aggregate is rebuilt, and the
staging partition of the batch is kept for exactly this purpose.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import lookups as L
from vitrine.operators import aggregates as A
from vitrine.operators import constraints as K
from vitrine.operators import dimensions as D
from vitrine.operators import facts as FT
from vitrine.operators import key_summary as KS
from vitrine.operators import late_items as LI
from vitrine.operators import quality as Q
from vitrine.operators.keys import keys_by_file
from vitrine.plans import reports as R
from vitrine.plans.runlog import RunLog, StepCounts
from vitrine.plans.warehouse import Warehouse, empty_table
from vitrine.session import scratch_path
from vitrine.sources import ingest as I
from vitrine.sources.feeds import FEEDS, Staging


@dataclass
class RunOptions:
    as_of: str | None = None  # "today" for SCD dates; default: the run date
    customer_lookup: str = "customer_id"  # or "bridge"
    strict: bool = False  # drop rejected rows from the loads
    one_review_per_id: bool = False
    product_versions: str = "current"  # or "all" (aggregate keeps items of expired product versions)
    incremental_refresh: bool = True  # the daily aggregate: only days that may differ (same result)
    long_rows: str = "reject"  # rows with more fields than columns; or "load" without the further fields
    constraints: str = "reject"  # rows that break a key go to the reject table; "fail" also fails the step; "off"
    enforce_calendar: bool = False  # an order's purchase day must be in the calendar
    late_items: str = "reject"  # items without order, product or seller are rejected; "park": they wait for later batches
    key_summaries: bool = False  # the facts' re-run guards open only the batches whose key summary allows a key
    error_limit: int | None = None  # rejected rows of a feed that stop a run; none by default
    started: dt.datetime | None = None  # set once per run, so a run over midnight has one date

    def day(self) -> str:
        return self.as_of or f"{self.started or dt.datetime.now(dt.timezone.utc):%Y-%m-%d}"

    def load_ts(self) -> str:
        if self.as_of is not None:
            return f"{self.as_of} 00:00:00"
        return f"{self.started or dt.datetime.now(dt.timezone.utc):%Y-%m-%d %H:%M:%S}"


def _count_observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs


class Pipeline:
    def __init__(self, spark: SparkSession, root: str, options: RunOptions | None = None):
        self.spark = spark
        self.wh = Warehouse(spark, root)
        self.log = RunLog(self.wh)
        self.opts = options or RunOptions()

    # ---------------------------------------------------------------- steps

    def validate_staging(self, stg: Staging, batch_id: int, attempt: int) -> DataFrame:
        with self.log.step(batch_id, L.STEP_DQ, attempt) as c:
            c.records_rejected = self._reject(Q.validate_staging(stg, batch_id), batch_id, attempt)
        mine = (F.col("etl_batch_id") == batch_id) & (F.col("attempt") == attempt)
        return self.wh.read("stg_rejected_records").filter(mine)

    def _reject(self, rows: DataFrame, batch_id: int, attempt: int) -> int:
        return self.wh.append_rejects(rows, batch_id, attempt, self.opts.load_ts())

    def _leave_out(self, rows: DataFrame, table: str, key: Column, raw: str, batch_id: int, attempt: int) -> int:
        """Rows a fact load leaves out (with their ``reason``), as reject rows."""
        return self._reject(
            rows.select(
                F.lit(table).alias("source_table"),
                F.coalesce(key.cast("string"), F.lit(L.NULL_KEY_TEXT)).alias("source_key"),
                F.col("reason").alias("reject_reason"),
                F.col(raw).cast("string").alias("raw_data"),
            ),
            batch_id,
            attempt,
        )

    def _reject_keyless(self, stg: Staging, table: str, batch_id: int, attempt: int) -> int:
        return self._reject(
            D.keyless_rows(stg, batch_id).filter(F.col("source_table") == table), batch_id, attempt
        )

    def _strict(self, stg: Staging, rejects: DataFrame) -> Staging:
        return Q.strict_staging(stg, rejects) if self.opts.strict else stg

    def load_dim_customer(self, stg: Staging, batch_id: int, attempt: int) -> None:
        with self.log.step(batch_id, L.STEP_DIM_CUSTOMER, attempt) as c:
            target = self.wh.current("dim_customer")
            src = D.customer_source(stg, batch_id)
            start = self.wh.max_value(target, "customer_key")
            merged = D.scd1_upsert(
                target, src, "customer_unique_id", "customer_key", D.CUSTOMER_COLUMNS, self.opts.load_ts(), start
            )
            merged, obs = _count_observed(
                merged, f"dim_customer_{batch_id}_{attempt}",
                changed=F.count_if(F.col("merge_action") != "KEEP"),
            )
            self.wh.publish("dim_customer", merged.drop("merge_action"))
            c.records_in = stg.customers.count()
            c.records_rejected = self._reject_keyless(stg, "STG_CUSTOMERS", batch_id, attempt)
            c.records_out = int(obs.get["changed"])
        self.log.set_watermarks(["CUSTOMERS"], batch_id)

    def load_dim_seller(self, stg: Staging, batch_id: int, attempt: int) -> None:
        with self.log.step(batch_id, L.STEP_DIM_SELLER, attempt) as c:
            src = D.seller_source(stg, batch_id)
            dups = Q.duplicate_keys(src, ["seller_id"], "STG_SELLERS").select(
                F.col("table_name").alias("source_table"),
                F.col("key_value").alias("source_key"),
                F.lit(L.REJECT_SELLER_ADDRESSES).alias("reject_reason"),
                F.col("occurrences").cast("string").alias("raw_data"),
            )
            if n := self._reject(dups, batch_id, attempt):
                c.records_rejected = n
                raise ValueError(f"{n} sellers have more than one address in batch {batch_id}; see the reject table")
            target = self.wh.current("dim_seller")
            start = self.wh.max_value(target, "seller_key")
            merged = D.scd1_upsert(target, src, "seller_id", "seller_key", D.SELLER_COLUMNS, self.opts.load_ts(), start)
            merged, obs = _count_observed(
                merged, f"dim_seller_{batch_id}_{attempt}", changed=F.count_if(F.col("merge_action") != "KEEP")
            )
            self.wh.publish("dim_seller", merged.drop("merge_action"))
            c.records_in = stg.sellers.count()
            c.records_rejected = self._reject_keyless(stg, "STG_SELLERS", batch_id, attempt)
            c.records_out = int(obs.get["changed"])
        self.log.set_watermarks(["SELLERS"], batch_id)

    def load_dim_product(self, stg: Staging, batch_id: int, attempt: int) -> None:
        with self.log.step(batch_id, L.STEP_DIM_PRODUCT, attempt) as c:
            history = self.wh.current("dim_product")
            start = self.wh.max_value(history, "product_key")
            src = D.product_source(stg, batch_id)
            changed = D.product_changes(history, stg, batch_id)
            new = D.scd2_apply(history, src, changed, self.opts.day(), batch_id, self.opts.load_ts(), start)
            new, obs = _count_observed(
                new, f"dim_product_{batch_id}_{attempt}", inserted=F.count_if(F.col("product_key") > start)
            )
            self.wh.publish("dim_product", new)
            c.records_in = stg.products.count()
            c.records_rejected = self._reject_keyless(stg, "STG_PRODUCTS", batch_id, attempt)
            c.records_out = int(obs.get["inserted"])
        self.log.set_watermarks(["PRODUCTS"], batch_id)

    FACT_KEYS = {
        "fact_orders": ["order_id"], "fact_order_items": ["order_id", "order_item_id"], "fact_reviews": ["review_id"],
    }

    def _keeps_summaries(self, table: str) -> bool:
        """Once a fact has summaries every later load keeps them up, whatever its options."""
        return self.opts.key_summaries or self.wh.exists(f"{table}_keys")

    def _loaded_keys(self, table: str, rows: DataFrame) -> DataFrame:
        """Keys of ``table`` for the guard of ``rows``: all, or those of the batches that can hold a key of ``rows``.

        Batches loaded before there were summaries get theirs first.
        """
        keys, loaded = self.FACT_KEYS[table], self.wh.read(table)
        if not self._keeps_summaries(table):
            return loaded.select(*keys)
        held = self.wh.batches(table)
        if missing := sorted(set(held) - set(self.wh.batches(f"{table}_keys"))):
            self.wh.append(f"{table}_keys", KS.summarise(loaded.where(F.col("etl_batch_id").isin(missing)), keys))
        if not self.opts.key_summaries:
            return loaded.select(*keys)
        # a batch whose rows all lack a key has no summary, and nothing that a key could equal
        return KS.possible_rows(loaded, self.wh.read(f"{table}_keys"), rows.select(*keys), keys).select(*keys)

    def _publish_fact(
        self, table: str, rows: DataFrame, rules: list, key_name: str, source: str, key: Column, batch_id: int, attempt: int
    ) -> tuple[int, int]:
        """Append the rows that keep the rules, with surrogate keys and the load time; returns (loaded, rejected).

        ``rows`` is a written table. Rows that break a rule become rejects in
        the same pass; with ``constraints="fail"`` they then fail the step
        before anything of it is published.
        """
        if self.opts.constraints not in ("reject", "fail", "off"):
            raise ValueError(f"constraints must be 'reject', 'fail' or 'off', not {self.opts.constraints!r}")
        split = scratch_path(self.spark, f"{table}-{batch_id}-{attempt}")
        K.write_split(K.gate(rows, rules if self.opts.constraints != "off" else []), split)
        rejected = 0
        if self.wh.fs.exists(f"{split}/ok=false"):
            bad = self.spark.read.parquet(f"{split}/ok=false")
            reason = F.concat(F.lit(L.REJECT_CONSTRAINT), F.col("violation")).alias("reason")
            rejected = self._leave_out(bad.select("*", reason), source, key, "order_date_key", batch_id, attempt)
            if self.opts.constraints == "fail":
                raise K.ConstraintViolation(f"{rejected} rows of {table} break a constraint; see the reject table")
        if self.wh.fs.exists(f"{split}/ok=true"):
            start = self.wh.max_value(self.wh.read(table), key_name)
            keyed = keys_by_file(self.spark, f"{split}/ok=true", rows.schema, key_name, start)
        else:
            keyed = rows.limit(0).withColumn(key_name, F.lit(None).cast("long"))
        if self._keeps_summaries(table):  # before the rows: a run that fails in between leaves a summary too wide
            self.wh.append(f"{table}_keys", KS.summarise(keyed, self.FACT_KEYS[table]))
        keyed = keyed.withColumn("etl_insert_dt", F.lit(self.opts.load_ts()).cast("timestamp"))
        names = empty_table(self.spark, self.wh.APPEND_SCHEMAS[table]).columns
        loaded = self.wh.append(table, keyed.select(*names))
        self.wh.fs.delete(split)
        return loaded, rejected

    def _written(self, rows: DataFrame, name: str) -> tuple[DataFrame, str]:
        scratch = scratch_path(self.spark, name)
        rows.write.parquet(scratch)
        return self.spark.read.schema(rows.schema).parquet(scratch), scratch

    def load_fact_orders(self, stg: Staging, batch_id: int, attempt: int) -> None:
        with self.log.step(batch_id, L.STEP_FACT_ORDERS, attempt) as c:
            loaded = self._loaded_keys("fact_orders", stg.orders)
            dim = self.wh.current("dim_customer")
            rows = FT.fact_orders(stg, dim, batch_id, loaded, self.opts.customer_lookup)
            unresolved = FT.fact_orders_unresolved(stg, dim, batch_id, loaded, self.opts.customer_lookup)
            c.records_rejected = self._leave_out(
                unresolved, "STG_ORDERS", F.col("order_id"), "customer_id", batch_id, attempt
            )
            rows, scratch = self._written(rows.select(*FT.FACT_ORDER_COLUMNS), f"orders-{batch_id}-{attempt}")
            rules: list[K.Rule] = [K.Unique("FACT_ORDERS_UK", ("order_id",))]
            if self.opts.enforce_calendar:
                rules.append(K.Parent("FACT_ORD_DATE_FK", ("order_date_key",), self.calendar(), ("date_key",)))
            c.records_out, bad = self._publish_fact(
                "fact_orders", rows, rules, "order_fact_key", "STG_ORDERS", F.col("order_id"), batch_id, attempt
            )
            c.records_rejected += bad
            self.wh.fs.delete(scratch)
            c.records_in = stg.orders.count()
        self.log.set_watermarks(["ORDERS"], batch_id)

    def load_fact_order_items(self, stg: Staging, batch_id: int, attempt: int) -> None:
        with self.log.step(batch_id, L.STEP_FACT_ITEMS, attempt) as c:
            if self.opts.late_items not in ("reject", "park"):
                raise ValueError(f"late_items must be 'reject' or 'park', not {self.opts.late_items!r}")
            park = self.opts.late_items == "park"
            waiting = self.wh.current("stg_items_waiting")
            tried = stg.order_items.select("order_id", "order_item_id")
            tried = tried.unionAll(waiting.select("order_id", "order_item_id")) if park else tried
            loaded = self._loaded_keys("fact_order_items", tried)
            products, sellers = self.wh.current("dim_product"), self.wh.current("dim_seller")
            if park:
                staged = Q.in_batch(stg.order_items, batch_id)
                rows = LI.try_items(waiting, staged, loaded, self.wh.read("fact_orders"), products, sellers, batch_id)
                left_out, resolves = F.col("outcome") == LI.REJECTED, F.col("outcome") == LI.LOADS
            else:
                rows = FT.resolved_items(stg, self.wh.current("dim_customer"), products, sellers, batch_id, loaded)
                left_out, resolves = F.col("reason").isNotNull(), F.col("reason").isNull()
            # resolved once: written to the shared folder, then split into facts and rejects
            rows, scratch = self._written(rows, f"items-{batch_id}-{attempt}")
            item = Q.item_key()
            c.records_rejected = self._leave_out(
                rows.filter(left_out), "STG_ORDER_ITEMS", item, "product_id", batch_id, attempt
            )
            loads = rows.filter(resolves).select(*FT.FACT_ITEM_COLUMNS)
            orders = self.wh.read("fact_orders")
            rules: list[K.Rule] = [
                K.Parent("FACT_ITEM_ORDER_FK", ("order_id",), orders, ("order_id",)),
                K.Unique("FACT_ITEMS_UK", ("order_id", "order_item_id")),
            ]
            c.records_out, bad = self._publish_fact(
                "fact_order_items", loads, rules, "item_fact_key", "STG_ORDER_ITEMS", item, batch_id, attempt
            )
            c.records_rejected += bad
            c.records_in = stg.order_items.count()
            if park:  # after the fact: a run that fails in between finds its loaded items again as repeated
                c.records_in += waiting.count()
                self.wh.publish("stg_items_waiting", LI.still_waiting(rows))
            self.wh.fs.delete(scratch)
        self.log.set_watermarks(["ORDER_ITEMS"], batch_id)

    def load_fact_reviews(self, stg: Staging, batch_id: int, attempt: int) -> None:
        with self.log.step(batch_id, L.STEP_FACT_REVIEWS, attempt) as c:
            loaded = self._loaded_keys("fact_reviews", stg.order_reviews)
            rows = FT.fact_reviews(stg, batch_id, loaded, self.opts.one_review_per_id)
            c.records_rejected = self._leave_out(
                FT.fact_reviews_unresolved(stg, batch_id, loaded), "STG_ORDER_REVIEWS", F.col("review_id"), "order_id",
                batch_id, attempt,
            )
            rows, scratch = self._written(rows.select(*FT.FACT_REVIEW_COLUMNS), f"reviews-{batch_id}-{attempt}")
            c.records_out, _ = self._publish_fact(
                "fact_reviews", rows, [], "review_fact_key", "STG_ORDER_REVIEWS", F.col("review_id"), batch_id, attempt
            )
            self.wh.fs.delete(scratch)
            c.records_in = stg.order_reviews.count()
        self.log.set_watermarks(["ORDER_REVIEWS"], batch_id)

    def refresh_agg_daily_sales(self, batch_id: int, attempt: int = 1) -> None:
        with self.log.step(batch_id, L.STEP_AGG_DAILY, attempt) as c:
            orders, items = self.wh.read("fact_orders"), self.wh.read("fact_order_items")
            customers, products = self.wh.current("dim_customer"), self.wh.current("dim_product")
            versions, last = self.opts.product_versions, 0
            if self.opts.incremental_refresh and self.wh.versions("agg_daily_sales"):
                previous = self.wh.current("agg_daily_sales")
                last = self.wh.max_value(previous, "etl_batch_id")  # 0: no row, so everything is new
            since = self._changed_since(last, batch_id) if last else None
            if since is not None:
                days = A.touched_days(orders, items, customers, products, since)
                agg = A.refresh_days(previous, days, orders, customers, items, products, versions)
            else:
                agg = A.agg_daily_sales(orders, customers, items, products, versions)
            agg = agg.withColumn("etl_batch_id", F.lit(batch_id).cast("long"))
            agg = agg.withColumn("etl_insert_dt", F.lit(self.opts.load_ts()).cast("timestamp"))
            c.records_out = self.wh.publish("agg_daily_sales", agg)
            c.records_in = self.wh.read("fact_order_items").count()

    def _changed_since(self, last: int, batch_id: int) -> int | None:
        """The lowest batch that may have written after the last refresh began (a re-run of an old one counts)."""
        steps = self.log.steps()
        refreshes = steps.filter((F.col("step_name") == L.STEP_AGG_DAILY) & (F.col("step_status") == "SUCCESS"))
        began = refreshes.agg(F.max("start_dt")).first()[0]
        if began is None:
            return None
        loads = F.col("step_name").startswith("LOAD_") & (F.col("event_ts") >= F.lit(began))
        lowest = steps.filter(loads).agg(F.min("batch_id")).first()[0]
        return min(b for b in (last, batch_id, lowest) if b is not None)

    # ----------------------------------------------------------------- runs

    def prune(self, keep: int) -> dict[str, list[int]]:
        """Delete all but the newest ``keep`` (at least 1) versions of each table; nothing calls this by itself."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        return {t: self.wh.prune(t, keep) for t in self.wh.SNAPSHOT_SCHEMAS}

    def _begin(self) -> None:
        """One clock reading for the whole run."""
        self.opts = replace(self.opts, started=dt.datetime.now(dt.timezone.utc))

    def run_all(self, batch_id: int, attempt: int = 1) -> None:
        """All transform steps of one batch, in dependency order."""
        stg = I.read_staging(self.wh, batch_id)
        rejects = self.validate_staging(stg, batch_id, attempt)
        stg = self._strict(stg, rejects)
        self.load_dim_customer(stg, batch_id, attempt)
        self.load_dim_seller(stg, batch_id, attempt)
        self.load_dim_product(stg, batch_id, attempt)
        self.load_fact_orders(stg, batch_id, attempt)
        self.load_fact_order_items(stg, batch_id, attempt)
        self.load_fact_reviews(stg, batch_id, attempt)
        self.refresh_agg_daily_sales(batch_id, attempt)

    def run_pipeline(
        self, triggered_by: str = "SCHEDULER", feeds_dir: str | None = None, staging: Staging | None = None
    ) -> int:
        """Open a batch, load its staging, transform, close.

        Staging comes from CSV feeds, from given DataFrames, or (with neither)
        from rows that an outside loader left in the staging tables as batch 0.
        """
        self._begin()
        self.log.seed_watermarks()
        batch_id = self.log.start_batch(triggered_by=triggered_by)
        try:
            with self.log.step(batch_id, L.STEP_TAG_STAGING) as c:
                if feeds_dir is not None:
                    loaded = I.ingest_all(self.wh, feeds_dir, batch_id, self.opts.load_ts(), self.opts.error_limit, self.opts.long_rows)
                    c.records_in = sum(a + b for a, b in loaded.values())
                    c.records_out = sum(a for a, _ in loaded.values())
                    c.records_rejected = sum(b for _, b in loaded.values())
                elif staging is not None:
                    c.records_out = sum(I.stage_batch(self.wh, staging, batch_id).values())
                    c.records_in = c.records_out
                else:
                    c.records_out = c.records_in = sum(I.claim_batch_zero(self.wh, batch_id).values())
            self.run_all(batch_id)
        except Exception as e:
            self.log.end_batch(batch_id, "FAILED", f"{type(e).__name__}: {e}")
            raise
        self.log.end_batch(batch_id, "SUCCESS")
        return batch_id

    def rerun_batch(self, batch_id: int) -> None:
        """Run the transforms of an earlier batch again on its kept staging partition."""
        self._begin()
        cur = self.log.batch(batch_id)
        if cur is None:
            raise KeyError(f"batch {batch_id} does not exist")
        for feed in FEEDS.values():
            if not self.wh.fs.exists(f"{self.wh.path(feed.table)}/etl_batch_id={batch_id}"):
                raise FileNotFoundError(f"staging of batch {batch_id} is gone ({feed.table}); cannot re-run")
        attempt = int(cur["attempt"]) + 1
        self.log.start_batch(cur["batch_name"], cur["pipeline_name"], cur["triggered_by"], batch_id, attempt, "RERUN")
        try:
            self.run_all(batch_id, attempt)
        except Exception as e:
            self.log.end_batch(batch_id, "FAILED", f"{type(e).__name__}: {e}")
            raise
        self.log.end_batch(batch_id, "SUCCESS")

    def refresh_hourly(self, triggered_by: str = "SCHEDULER") -> int:
        """The hourly job: its own batch row around an aggregate refresh."""
        self._begin()
        batch_id = self.log.start_batch(
            f"{L.HOURLY_BATCH_PREFIX}{self.opts.started:%H%M%S}", L.HOURLY_PIPELINE_NAME, triggered_by
        )
        try:
            self.refresh_agg_daily_sales(batch_id)
        except Exception as e:
            self.log.end_batch(batch_id, "FAILED", f"{type(e).__name__}: {e}")
            raise
        self.log.end_batch(batch_id, "SUCCESS")
        return batch_id

    # -------------------------------------------------------------- reports

    def top_categories(self, n: int = 10) -> DataFrame:
        items, orders = self.wh.read("fact_order_items"), self.wh.read("fact_orders")
        return R.top_categories(items, orders, self.wh.current("dim_product"), n, self.opts.product_versions)

    def monthly_revenue(self) -> DataFrame:
        """Delivered orders and revenue per month of the warehouse calendar."""
        return R.monthly_revenue(self.wh.read("fact_orders"), self.calendar())

    def late_rate_by_state(self) -> DataFrame:
        return R.late_rate_by_state(self.wh.read("fact_orders"), self.wh.current("dim_customer"))

    def calendar(self) -> DataFrame:
        """The stored calendar table; written on first use."""
        if not self.wh.versions("dim_date"):
            self.wh.publish("dim_date", A.dim_date(self.spark))
        return self.wh.current("dim_date")

    def constraint_errors(self) -> DataFrame:
        """Keys of the loaded tables that occur twice or point nowhere: (constraint_name, key_value, occurrences)."""
        orders, items, dates = self.wh.read("fact_orders"), self.wh.read("fact_order_items"), self.calendar()
        named = {
            "dim_customer": (self.wh.current("dim_customer"), ["customer_unique_id"]),
            "dim_seller": (self.wh.current("dim_seller"), ["seller_id"]),
            "fact_orders": (orders, ["order_id"]),
            "fact_order_items": (items, ["order_id", "order_item_id"]),
            "dim_date": (dates, ["date_key"]),
        }
        out = None
        for table, (df, keys) in named.items():
            dup = Q.duplicate_keys(df, keys, table.upper()).withColumnRenamed("table_name", "constraint_name")
            out = dup if out is None else out.unionByName(dup)
        for child, col, parent, name in (
            (orders, "customer_key", self.wh.current("dim_customer"), "FACT_ORD_CUST_FK"),
            (items, "product_key", self.wh.current("dim_product"), "FACT_ITEM_PROD_FK"),
            (items, "seller_key", self.wh.current("dim_seller"), "FACT_ITEM_SELL_FK"),
        ):
            out = out.unionByName(Q.orphans(child, [col], parent, [col], name))
        return out.unionByName(Q.orphans(orders, ["order_date_key"], dates, ["date_key"], "FACT_ORD_DATE_FK"))

    def health_check(self, n: int = 5) -> DataFrame:
        return R.health_check(self.log.batches(), n)

    def run_history(self) -> DataFrame:
        return R.run_history(self.log.batches())

    def step_detail(self, batch_id: int) -> DataFrame:
        return R.step_detail(self.log.steps(), batch_id)
