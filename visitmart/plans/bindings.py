"""Present the driver's test tables as the clinical entities the jobs read.

The jobs are written against a schedule / visit / patient model. The test
data is a TPC-H-like star schema plus an event stream, so each entity is a
view over it. Every view exists twice: as a lazy DataFrame (used by the
Spark queries) and as SQL text (used by the DuckDB oracle), with the same
column names and the same derivations.

Mapping (one line per entity):

* patient / vw_patient / ident / admin / ref_patients: ``customer``
  (+ ``nation`` for city); name "LAST, FIRST" from ``c_name``; MRN is the
  zero-padded key; ``c_acctbal < 0`` marks a death and an invalid patient.
* prompt (ethnicity, language): ``nation``; race: ``region`` via nation;
  facility: ``region``; external doctors and staff: ``supplier``.
* visits (visits_in_buckets), diagnoses: ``lineitem`` x ``orders`` x
  ``part``; day = order date, code = ``p_type``, specialty = ``p_brand``.
* schedule (one row per order line): appointment = ship date, created and
  edited = order date, set = order, current version = return flag ``N``,
  status = line status, system status = order status, activity = part key.
* cpt: ``part``; activity buckets: distinct part types. Schedule activities
  are the part's code in either case, some with a trailing blank, and one in
  17 has no entry in the dictionary; statuses come in either case; one
  appointment in 13 is not staffed.
* event schedule, scheduled sets, vitals, drugs, patient log: ``events``.

Broadcast hints are only put on ``nation`` and ``region``: their size is
fixed by the domain (25 and 5 rows). Every other dimension grows with the
data and is left to the planner's size threshold and AQE.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import name_lfm
from ..model import schema_of

_TABLES: dict[tuple, DataFrame] = {}
_BOUND: dict[tuple, "Bound"] = {}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Choices of this binding.
PHYSICIAN_BUCKET = "Group A"
PHYSICIAN_TYPES = ("ECONOMY", "PROMO", "STANDARD")   # part types bucketed as physician visits
OTHER_BUCKET = "Group B"
DEATH_MARK = "D"
REFERRAL_NATION_LIMIT = 20


def _s(x: str):
    return F.lit(x)


def _null(t: str):
    return F.lit(None).cast(t)


def _pad(col, n: int):
    return F.lpad(col.cast("string"), n, "0")


@dataclass
class Bound:
    """Lazy clinical views over one directory of test tables."""

    spark: SparkSession
    sf_dir: str

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Bound":
        """The views of one directory, defined once per session.

        The views are lazy, immutable DataFrames, so queries share them the
        way an application shares the views of its catalog.
        """
        key = (id(spark), sf_dir)
        b = _BOUND.get(key)
        if b is None or b.spark is not spark:
            b = _BOUND[key] = cls(spark, sf_dir)
        return b

    def table(self, name: str) -> DataFrame:
        """The table as a lazy DataFrame, read with its declared schema.

        One handle per (session, table) is kept, as a long-running
        application keeps its catalog: later queries do not list the files
        again. The tables are immutable inputs.
        """
        key = (id(self.spark), self.sf_dir, name)
        df = _TABLES.get(key)
        if df is None or df.sparkSession is not self.spark:
            reader = self.spark.read
            ddl = schema_of(name)
            if ddl:
                reader = reader.schema(ddl)
            df = _TABLES[key] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return df

    # -- fixed-domain lookups ------------------------------------------------
    @cached_property
    def nation(self) -> DataFrame:
        return F.broadcast(self.table("nation"))

    @cached_property
    def region(self) -> DataFrame:
        return F.broadcast(self.table("region"))

    # -- patients --------------------------------------------------------------
    def _customer_names(self) -> DataFrame:
        c = self.table("customer")
        last = F.upper(F.split_part(c.c_name, _s("#"), F.lit(1)))
        first = F.split_part(c.c_name, _s("#"), F.lit(2))
        return c.select(
            c.c_custkey.alias("pat_id1"), last.alias("last_name"), first.alias("first_name"),
            name_lfm(last, first).alias("pat_name"),
            _pad(c.c_custkey, 9).alias("ida"),
            "c_acctbal", "c_mktsegment", "c_nationkey", "c_name")

    @cached_property
    def patient(self) -> DataFrame:
        c = self._customer_names()
        return c.select(
            "pat_id1", "last_name", "first_name", _null("string").alias("middle_name"),
            F.when(c.c_acctbal >= 5000, _s("Dr.")).otherwise(_s("Mx.")).alias("salutation"),
            "pat_name")

    @cached_property
    def vw_patient(self) -> DataFrame:
        c = self._customer_names()
        dob = F.date_add(F.lit("1930-01-01").cast("date"),
                         F.floor((c.c_acctbal + 1000) * 2.5).cast("int"))
        return c.select("pat_id1", "ida", dob.cast("timestamp_ntz").alias("birth_dttm"))

    @cached_property
    def ident(self) -> DataFrame:
        c = self._customer_names()
        return c.select(
            "pat_id1", "ida",
            F.when(c.c_acctbal < 0, _s(DEATH_MARK)).alias("idc"),
            c.pat_id1.alias("ident_id"), F.lit(0).alias("version"))

    @cached_property
    def admin(self) -> DataFrame:
        c = self._customer_names()
        n = self.nation
        j = c.join(n, c.c_nationkey == n.n_nationkey)
        referred = j.c_nationkey < REFERRAL_NATION_LIMIT
        return j.select(
            "pat_id1",
            F.substring(j.c_mktsegment, 1, 1).alias("gender"),
            j.c_mktsegment.alias("pat_adr1"),
            j.c_name.alias("pat_adr2"),
            j.n_name.alias("pat_city"),
            F.concat(_s("R"), j.n_regionkey.cast("string")).alias("pat_state"),
            _pad(j.c_nationkey, 5).alias("pat_postal"),
            _pad(j.pat_id1, 10).alias("pat_home_phone"),
            _null("string").alias("pat_work_phone"),
            _null("string").alias("pat_work_phone_ex"),
            _null("string").alias("pat_cellphone"),
            F.concat(F.lower(F.replace(j.c_name, _s("#"), _s("."))), _s("@example.org")).alias("pat_email"),
            _null("timestamp_ntz").alias("expired_dttm"),
            j.c_nationkey.cast("bigint").alias("language_pro_id"),
            j.c_nationkey.cast("bigint").alias("ethnicity_pro_id"),
            F.when(referred, j.n_regionkey.cast("bigint")).alias("ref_fac_id"),
            F.when(referred, j.c_nationkey.cast("bigint")).alias("ref_md_id"))

    @cached_property
    def patient_profile(self) -> DataFrame:
        """What the volumes read of a patient, from one scan of the customers:
        the same rows as ``volumes.patient_profile(admin, vw_patient, patient_race)``."""
        c = self.table("customer")
        n, r = self.nation, self.region
        j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
        dob = F.date_add(F.lit("1930-01-01").cast("date"), F.floor((j.c_acctbal + 1000) * 2.5).cast("int"))
        referred = j.c_nationkey < REFERRAL_NATION_LIMIT
        return j.select(j.c_custkey.alias("pat_id1"), _pad(j.c_nationkey, 5).alias("pat_postal"),
                        j.c_nationkey.cast("bigint").alias("ethnicity_pro_id"),
                        F.substring(j.c_mktsegment, 1, 1).alias("gender"),
                        F.when(referred, j.n_regionkey.cast("bigint")).alias("ref_fac_id"),
                        F.when(referred, j.c_nationkey.cast("bigint")).alias("ref_md_id"),
                        dob.cast("timestamp_ntz").alias("birth_dttm"), j.r_name.alias("race"))

    @cached_property
    def ref_patients(self) -> DataFrame:
        c = self._customer_names()
        return c.select("pat_id1", "ida", c.pat_name.alias("pat_id1_name"),
                        F.when(c.c_acctbal >= 0, _s("Y")).otherwise(_s("N")).alias("is_valid"))

    @cached_property
    def prompt(self) -> DataFrame:
        n = self.nation
        return n.select(n.n_nationkey.cast("bigint").alias("pro_id"), n.n_name.alias("description"))

    @cached_property
    def patient_race(self) -> DataFrame:
        c = self.table("customer")
        n, r = self.nation, self.region
        return (c.join(n, c.c_nationkey == n.n_nationkey)
                 .join(r, F.col("n_regionkey") == r.r_regionkey)
                 .select(c.c_custkey.alias("pat_id1"), r.r_name.alias("race")))

    @cached_property
    def patient_provider(self) -> DataFrame:
        c = self.table("customer")
        s = self.table("supplier")
        return (c.join(s, c.c_nationkey.cast("bigint") == s.s_suppkey)
                 .select(c.c_custkey.alias("pat_id1"), s.s_name.alias("provider_name")))

    @cached_property
    def facility(self) -> DataFrame:
        r = self.region
        return r.select(r.r_regionkey.cast("bigint").alias("fac_id"), r.r_name.alias("name"))

    @cached_property
    def external(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(
            s.s_suppkey.alias("pnp_id"),
            F.when(s.s_acctbal >= 0, F.split_part(s.s_name, _s("#"), F.lit(2))).alias("first_name"),
            F.split_part(s.s_name, _s("#"), F.lit(1)).alias("last_name"))

    @cached_property
    def staff(self) -> DataFrame:
        s = self.table("supplier")
        n = self.nation
        return (s.join(n, s.s_nationkey == n.n_nationkey)
                 .select(s.s_suppkey.alias("staff_id"), n.n_name.alias("last_name"),
                         s.s_name.alias("first_name"), s.s_nationkey.alias("location_id")))

    # -- activities --------------------------------------------------------
    @cached_property
    def cpt(self) -> DataFrame:
        p = self.table("part")
        return p.select(F.concat(_s("P"), p.p_partkey.cast("string")).alias("hsp_code"), p.p_brand.alias("hsp_code3"),
                        p.p_type.alias("cpt_code"), p.p_name.alias("description"),
                        p.p_name.alias("short_desc"))

    @cached_property
    def bucket_ref(self) -> DataFrame:
        p = self.table("part")
        types = p.select(p.p_type.alias("actv_code")).distinct()
        return types.select(
            "actv_code", F.lower(types.actv_code).alias("actv_class"),
            F.when(types.actv_code.isin(*PHYSICIAN_TYPES), _s(PHYSICIAN_BUCKET))
             .otherwise(_s(OTHER_BUCKET)).alias("actv_bucket"))

    # -- visits and diagnoses ----------------------------------------------
    def _order_lines(self, lines: DataFrame | None = None) -> DataFrame:
        li = self.table("lineitem") if lines is None else lines
        o = self.table("orders")
        return li.join(o, li.l_orderkey == o.o_orderkey)

    def _coded_lines(self) -> DataFrame:
        """Order lines with their part, joined before the orders: the part carries
        the selective code and specialty predicates, so only the lines that
        pass them are shuffled to meet the orders."""
        li = self.table("lineitem")
        p = self.table("part")
        return li.join(p, li.l_partkey == p.p_partkey)

    @cached_property
    def diagnoses(self) -> DataFrame:
        j = self._order_lines(self._coded_lines())
        return j.select(F.col("o_custkey").alias("pat_id1"),
                        F.to_date(F.col("o_orderdate")).alias("appt_date"),
                        j.p_brand.alias("diag_code"), j.p_name.alias("diag_desc"))

    @cached_property
    def visits(self) -> DataFrame:
        s = self.table("supplier")
        # The patient key is taken from the order, so a patient filter on
        # the view (semi-join, IN list) can be pushed to the orders side.
        names = self._customer_names().select(F.col("pat_id1").alias("c_key"), "pat_name")
        j = (self._order_lines(self._coded_lines())
             .join(s, F.col("l_suppkey") == s.s_suppkey)
             .join(names, F.col("o_custkey") == names.c_key))
        return j.select(
            j.o_custkey.alias("pat_id1"),
            j.pat_name.alias("patient_name"),
            _pad(j.o_custkey, 9).alias("pat_mrn"),
            F.date_format(j.o_orderdate, "yyyyMMdd").alias("appt_dt"),
            F.to_date(j.o_orderdate).alias("appt_date"),
            j.p_type.alias("actv_code"),
            j.p_name.alias("actv_code_desc"),
            j.p_name.alias("actv_desc"),
            F.when(j.l_linestatus == "O", _s("Y")).otherwise(_s("N")).alias("is_telemed"),
            j.s_name.alias("prov_name_last_mq"),
            F.when(j.s_acctbal >= 0, F.split_part(j.s_name, _s("#"), F.lit(2))).alias("prov_name_first_mq"),
            j.p_brand.alias("prov_specialty_type_mq"),
            j.l_returnflag.alias("sch_status_prim"),
            F.year(j.o_orderdate).alias("fy"))

    # -- schedule --------------------------------------------------------------
    @cached_property
    def schedule(self) -> DataFrame:
        j = self._order_lines()
        return j.select(
            (j.l_orderkey * 1000 + j.l_linenumber).alias("sch_id"),
            j.l_orderkey.alias("sch_set_id"),
            j.o_custkey.alias("pat_id1"),
            F.when(j.l_returnflag == "N", 0).otherwise(1).alias("version"),
            j.l_shipdate.alias("app_dttm"),
            j.o_orderdate.alias("create_dttm"),
            j.o_orderdate.alias("edit_dttm"),
            F.concat(F.when(j.l_partkey % 17 == 0, _s("X")).when(j.l_linenumber % 2 == 0, _s("p")).otherwise(_s("P")),
                     j.l_partkey.cast("string"),
                     F.when(j.l_linenumber % 3 == 0, _s(" ")).otherwise(_s(""))).alias("activity"),
            F.when(j.l_suppkey % 13 != 0, j.l_suppkey).alias("staff_id"),
            j.l_suppkey.alias("location"),
            j.l_partkey.alias("attending_md_id"),
            j.o_orderpriority.alias("notes"),
            F.when(j.l_linenumber % 2 == 0, F.lower(j.l_linestatus)).otherwise(j.l_linestatus).alias("schstatus_hist_sd"),
            F.when(j.l_linenumber % 2 == 0, F.concat(F.lower(j.o_orderstatus), _s(" ")))
             .otherwise(j.o_orderstatus).alias("sysdefstatus"),
            j.o_orderpriority.alias("dept"))

    @cached_property
    def vw_schedule(self) -> DataFrame:
        sch = self.schedule
        names = self._customer_names().select("pat_id1", "pat_name", "ida")
        stf = self.staff
        p = self.table("part")
        j = (sch.join(names, "pat_id1")
                .join(stf, sch.staff_id == stf.staff_id, "left")
                .join(p, sch.attending_md_id == p.p_partkey, "left"))
        return j.select(
            sch.sch_id, sch.pat_id1, j.ida, j.pat_name, sch.app_dttm, sch.create_dttm,
            sch.activity, j.p_name.alias("short_desc"),
            stf.last_name.alias("location_name"), stf.location_id,
            sch.staff_id, stf.last_name.alias("stf_last_name"), stf.first_name.alias("stf_first_name"),
            sch.attending_md_id, sch.sysdefstatus, sch.dept)

    # -- event stream ----------------------------------------------------------
    @cached_property
    def event_schedule(self) -> DataFrame:
        """Appointments booked from events: one per event, booked
        ``floor(value)`` hours ahead, resource group = event type."""
        e = self.table("events")
        names = self._customer_names().select("pat_id1", "pat_name", "ida")
        j = e.join(names, e.user_id == names.pat_id1)
        created = j.ts - F.make_dt_interval(F.lit(0), F.floor(j.value).cast("int"))
        return j.select(
            j.event_id.alias("sch_id"), j.pat_id1, j.ida, j.pat_name,
            j.ts.alias("app_dttm"), created.alias("create_dttm"),
            F.concat(_s("k"), F.regexp_extract(j.props, r"\d+", 0)).alias("activity"),
            F.concat(j.event_type, _s(" visit")).alias("short_desc"),
            F.concat(_s("Suite "), j.event_type).alias("location_name"),
            F.lit(0).alias("location_id"),
            j.user_id.alias("staff_id"), j.event_type.alias("stf_last_name"),
            _null("string").alias("stf_first_name"), _null("bigint").alias("attending_md_id"),
            _null("string").alias("sysdefstatus"), _null("string").alias("dept"))

    @cached_property
    def sch_sets(self) -> DataFrame:
        e = self.table("events")
        return e.filter(e.event_type == "view").select(
            e.user_id.alias("pat_id1"), F.to_date(e.ts).alias("appt_date"))

    @cached_property
    def observations(self) -> DataFrame:
        e = self.table("events")
        return e.select(e.user_id.alias("pat_id1"), e.event_type.alias("observation_bucket"),
                        e.ts.alias("measurement_dttm"))

    @cached_property
    def drugs(self) -> DataFrame:
        e = self.table("events")
        return e.filter(e.event_type == "purchase").select(
            e.user_id.alias("pat_id1"), e.ts.alias("adm_start_dttm"))

    @cached_property
    def patlog(self) -> DataFrame:
        e = self.table("events")
        return e.select(e.user_id.alias("pat_id1"), e.event_type.alias("plc_id"),
                        F.when(e.value > 190, _null("timestamp_ntz")).otherwise(e.ts).alias("inactive_dttm"))

    def status_keys(self, status: str) -> DataFrame:
        """Cancellation / no-show key tables: orders of one status."""
        o = self.table("orders")
        return o.filter(o.o_orderstatus == status).select(
            o.o_custkey.alias("pat_id1"), o.o_orderdate.alias("app_dttm"))


# ---------------------------------------------------------------------------
# The same views as DuckDB SQL, for the oracle. Dependencies come first.
# ---------------------------------------------------------------------------

_PHYS = ", ".join(f"'{t}'" for t in PHYSICIAN_TYPES)

SQL_VIEWS: dict[str, str] = {
    "cust_names": """
        SELECT c_custkey AS pat_id1,
               upper(split_part(c_name, '#', 1)) AS last_name,
               split_part(c_name, '#', 2) AS first_name,
               upper(split_part(c_name, '#', 1)) || ', ' || split_part(c_name, '#', 2) AS pat_name,
               lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ida,
               c_acctbal, c_mktsegment, c_nationkey, c_name
        FROM customer""",
    "v_patient": """
        SELECT pat_id1, last_name, first_name, CAST(NULL AS VARCHAR) AS middle_name,
               CASE WHEN c_acctbal >= 5000 THEN 'Dr.' ELSE 'Mx.' END AS salutation, pat_name
        FROM cust_names""",
    "v_vw_patient": """
        SELECT pat_id1, ida,
               CAST(DATE '1930-01-01' + CAST(floor((c_acctbal + 1000) * 2.5) AS INTEGER) AS TIMESTAMP) AS birth_dttm
        FROM cust_names""",
    "v_ident": f"""
        SELECT pat_id1, ida, CASE WHEN c_acctbal < 0 THEN '{DEATH_MARK}' END AS idc,
               pat_id1 AS ident_id, 0 AS version
        FROM cust_names""",
    "v_admin": f"""
        SELECT c.pat_id1,
               substr(c.c_mktsegment, 1, 1) AS gender,
               c.c_mktsegment AS pat_adr1,
               c.c_name AS pat_adr2,
               n.n_name AS pat_city,
               'R' || CAST(n.n_regionkey AS VARCHAR) AS pat_state,
               lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS pat_postal,
               lpad(CAST(c.pat_id1 AS VARCHAR), 10, '0') AS pat_home_phone,
               CAST(NULL AS VARCHAR) AS pat_work_phone,
               CAST(NULL AS VARCHAR) AS pat_work_phone_ex,
               CAST(NULL AS VARCHAR) AS pat_cellphone,
               lower(replace(c.c_name, '#', '.')) || '@example.org' AS pat_email,
               CAST(NULL AS TIMESTAMP) AS expired_dttm,
               CAST(c.c_nationkey AS BIGINT) AS language_pro_id,
               CAST(c.c_nationkey AS BIGINT) AS ethnicity_pro_id,
               CASE WHEN c.c_nationkey < {REFERRAL_NATION_LIMIT} THEN CAST(n.n_regionkey AS BIGINT) END AS ref_fac_id,
               CASE WHEN c.c_nationkey < {REFERRAL_NATION_LIMIT} THEN CAST(c.c_nationkey AS BIGINT) END AS ref_md_id
        FROM cust_names c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "v_ref_patients": """
        SELECT pat_id1, ida, pat_name AS pat_id1_name,
               CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS is_valid
        FROM cust_names""",
    "v_prompt": """
        SELECT CAST(n_nationkey AS BIGINT) AS pro_id, n_name AS description FROM nation""",
    "v_patient_race": """
        SELECT c.c_custkey AS pat_id1, r.r_name AS race
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_patient_provider": """
        SELECT c.c_custkey AS pat_id1, s.s_name AS provider_name
        FROM customer c JOIN supplier s ON CAST(c.c_nationkey AS BIGINT) = s.s_suppkey""",
    "v_facility": """
        SELECT CAST(r_regionkey AS BIGINT) AS fac_id, r_name AS name FROM region""",
    "v_external": """
        SELECT s_suppkey AS pnp_id,
               CASE WHEN s_acctbal >= 0 THEN split_part(s_name, '#', 2) END AS first_name,
               split_part(s_name, '#', 1) AS last_name
        FROM supplier""",
    "v_staff": """
        SELECT s.s_suppkey AS staff_id, n.n_name AS last_name, s.s_name AS first_name,
               s.s_nationkey AS location_id
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "v_cpt": """
        SELECT 'P' || CAST(p_partkey AS VARCHAR) AS hsp_code, p_brand AS hsp_code3, p_type AS cpt_code,
               p_name AS description, p_name AS short_desc
        FROM part""",
    "v_bucket_ref": f"""
        SELECT actv_code, lower(actv_code) AS actv_class,
               CASE WHEN actv_code IN ({_PHYS}) THEN '{PHYSICIAN_BUCKET}' ELSE '{OTHER_BUCKET}' END AS actv_bucket
        FROM (SELECT DISTINCT p_type AS actv_code FROM part) t""",
    "order_lines": """
        SELECT * FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "v_diagnoses": """
        SELECT ol.o_custkey AS pat_id1, CAST(ol.o_orderdate AS DATE) AS appt_date,
               p.p_brand AS diag_code, p.p_name AS diag_desc
        FROM order_lines ol JOIN part p ON ol.l_partkey = p.p_partkey""",
    "v_visits": """
        SELECT ol.o_custkey AS pat_id1,
               cn.pat_name AS patient_name,
               lpad(CAST(ol.o_custkey AS VARCHAR), 9, '0') AS pat_mrn,
               strftime(ol.o_orderdate, '%Y%m%d') AS appt_dt,
               CAST(ol.o_orderdate AS DATE) AS appt_date,
               p.p_type AS actv_code,
               p.p_name AS actv_code_desc,
               p.p_name AS actv_desc,
               CASE WHEN ol.l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS is_telemed,
               s.s_name AS prov_name_last_mq,
               CASE WHEN s.s_acctbal >= 0 THEN split_part(s.s_name, '#', 2) END AS prov_name_first_mq,
               p.p_brand AS prov_specialty_type_mq,
               ol.l_returnflag AS sch_status_prim,
               CAST(year(ol.o_orderdate) AS INTEGER) AS fy
        FROM order_lines ol
        JOIN part p ON ol.l_partkey = p.p_partkey
        JOIN supplier s ON ol.l_suppkey = s.s_suppkey
        JOIN cust_names cn ON ol.o_custkey = cn.pat_id1""",
    "v_schedule": """
        SELECT l_orderkey * 1000 + l_linenumber AS sch_id,
               l_orderkey AS sch_set_id,
               o_custkey AS pat_id1,
               CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS version,
               l_shipdate AS app_dttm,
               o_orderdate AS create_dttm,
               o_orderdate AS edit_dttm,
               CASE WHEN l_partkey % 17 = 0 THEN 'X' WHEN l_linenumber % 2 = 0 THEN 'p' ELSE 'P' END
                 || CAST(l_partkey AS VARCHAR) || CASE WHEN l_linenumber % 3 = 0 THEN ' ' ELSE '' END AS activity,
               CASE WHEN l_suppkey % 13 <> 0 THEN l_suppkey END AS staff_id,
               l_suppkey AS location,
               l_partkey AS attending_md_id,
               o_orderpriority AS notes,
               CASE WHEN l_linenumber % 2 = 0 THEN lower(l_linestatus) ELSE l_linestatus END AS schstatus_hist_sd,
               CASE WHEN l_linenumber % 2 = 0 THEN lower(o_orderstatus) || ' ' ELSE o_orderstatus END AS sysdefstatus,
               o_orderpriority AS dept
        FROM order_lines""",
    "v_vw_schedule": """
        SELECT sch.sch_id, sch.pat_id1, cn.ida, cn.pat_name, sch.app_dttm, sch.create_dttm,
               sch.activity, p.p_name AS short_desc,
               stf.last_name AS location_name, stf.location_id,
               sch.staff_id, stf.last_name AS stf_last_name, stf.first_name AS stf_first_name,
               sch.attending_md_id, sch.sysdefstatus, sch.dept
        FROM v_schedule sch
        JOIN cust_names cn ON sch.pat_id1 = cn.pat_id1
        LEFT JOIN v_staff stf ON sch.staff_id = stf.staff_id
        LEFT JOIN part p ON sch.attending_md_id = p.p_partkey""",
    "v_event_schedule": """
        SELECT e.event_id AS sch_id, cn.pat_id1, cn.ida, cn.pat_name,
               e.ts AS app_dttm,
               e.ts - to_hours(CAST(floor(e.value) AS BIGINT)) AS create_dttm,
               'k' || regexp_extract(e.props, '\\d+', 0) AS activity, e.event_type || ' visit' AS short_desc,
               'Suite ' || e.event_type AS location_name, 0 AS location_id,
               e.user_id AS staff_id, e.event_type AS stf_last_name,
               CAST(NULL AS VARCHAR) AS stf_first_name, CAST(NULL AS BIGINT) AS attending_md_id,
               CAST(NULL AS VARCHAR) AS sysdefstatus, CAST(NULL AS VARCHAR) AS dept
        FROM events e JOIN cust_names cn ON e.user_id = cn.pat_id1""",
    "v_sch_sets": """
        SELECT user_id AS pat_id1, CAST(ts AS DATE) AS appt_date FROM events WHERE event_type = 'view'""",
    "v_observations": """
        SELECT user_id AS pat_id1, event_type AS observation_bucket, ts AS measurement_dttm FROM events""",
    "v_drugs": """
        SELECT user_id AS pat_id1, ts AS adm_start_dttm FROM events WHERE event_type = 'purchase'""",
    "v_patlog": """
        SELECT user_id AS pat_id1, event_type AS plc_id,
               CASE WHEN value > 190 THEN CAST(NULL AS TIMESTAMP) ELSE ts END AS inactive_dttm
        FROM events""",
}

_DEPENDS = {
    "v_patient": ["cust_names"], "v_vw_patient": ["cust_names"], "v_ident": ["cust_names"],
    "v_admin": ["cust_names"], "v_ref_patients": ["cust_names"],
    "v_diagnoses": ["order_lines"], "v_visits": ["order_lines", "cust_names"],
    "v_schedule": ["order_lines"], "v_vw_schedule": ["v_schedule", "cust_names", "v_staff"],
    "v_event_schedule": ["cust_names"],
}


def sql_with(body: str, *views: str) -> str:
    """Prefix ``body`` with the CTEs it names, dependencies first."""
    order: list[str] = []

    def visit(v: str) -> None:
        for d in _DEPENDS.get(v, []):
            visit(d)
        if v not in order:
            order.append(v)

    for v in views:
        visit(v)
    ctes = ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in order)
    return f"WITH {ctes}\n{body}" if ctes else body
