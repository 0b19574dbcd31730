"""Study-shaped tables derived from the supplied tables.

Every function is a projection or aggregate of whole tables; SURVEY section 7.3 gives the
correspondence.  ``oracle.py`` states the same derivations in SQL.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = 8  # of an export
PHASE1 = ("2024-01-01", "2024-01-15")
PHASE2 = ("2024-01-15", "2024-01-29")
ORDER_PHASE2 = "1998-05-01"
DOMAINS = ("anxiety", "cf", "dep", "fatigue", "pain", "pf", "sleep", "social")
BLOCK_NAMES = ("bl", "mp", "eos")


def scratch(spark: SparkSession) -> str:
    """The folder that all executors share; unset (local runs), a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='phasewise-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Tables:
    """The supplied parquet tables and the study tables made of them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- surveys from events -------------------------------------------------------

    def events(self) -> DataFrame:
        """Events with participant id, day and the number inside the JSON properties."""
        return self.raw("events").select(
            F.col("user_id").cast("string").alias("pId"),
            "event_id",
            "event_type",
            "ts",
            F.to_date("ts").alias("date"),
            "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    def responses(self) -> DataFrame:
        kind = (
            F.when(F.col("event_type") == "click", "DAILY")
            .when(F.col("event_type") == "view", "MORNING")
            .when(F.col("event_type") == "purchase", "EVENING")
            .otherwise(F.upper("event_type"))
        )
        k = F.col("k")
        note = F.when(k % 3 == 1, "").when(k % 3 == 2, "text")
        return self.events().select(
            "pId",
            F.concat_ws("_", "pId", kind, "event_id").alias("surveyId"),
            kind.alias("sId"),
            "date",
            F.col("ts").alias("startTime"),
            k.cast("double").alias("timeTaken"),
            F.when(k != 0, F.col("value")).alias("goodnessScore"),
            note.alias("note"),
        )

    def phases(self) -> DataFrame:
        """Two phases and a waiting state for every user seen in the events."""

        def span(name: str, start: str, end: str) -> Column:
            return F.struct(
                F.lit(name).alias("phaseId"),
                F.lit(start).cast("date").alias("startDate"),
                F.lit(end).cast("date").alias("endDate"),
            )

        spans = F.array(
            span("NOT_STARTED", "2023-12-01", "2024-01-01"),
            span("PHASE_1", *PHASE1),
            span("PHASE_2", *PHASE2),
        )
        users = self.raw("events").select(F.col("user_id").cast("string").alias("pId")).distinct()
        return users.select("pId", F.inline(spans))

    # ---- activities from orders ----------------------------------------------------

    def order_lines(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").cast("string").alias("pId"),
                F.col("l_partkey").cast("string").alias("activityId"),
                F.to_date("o_orderdate").alias("date"),
                "l_orderkey",
            )
        )

    def preferences(self) -> DataFrame:
        phase = F.when(F.col("date") < F.lit(ORDER_PHASE2).cast("date"), "1").otherwise("2")
        return self.order_lines().select(
            "pId", "activityId", F.concat("pId", F.lit("_PHASE_"), phase).alias("participantPhaseId")
        )

    def activities(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").cast("string").alias("activityId"), F.col("p_name").alias("name")
        )

    def user_activities(self) -> DataFrame:
        return self.raw("supplier").select(
            F.concat(F.lit("s"), F.col("s_suppkey")).alias("activityId"),
            F.col("s_name").alias("name"),
        )

    def activity_phases(self) -> DataFrame:
        def span(name: str, start: str, end: str) -> Column:
            return F.struct(
                F.lit(name).alias("phaseId"),
                F.lit(start).cast("date").alias("startDate"),
                F.lit(end).cast("date").alias("endDate"),
            )

        spans = F.array(
            span("PHASE_1", "1995-01-01", ORDER_PHASE2), span("PHASE_2", ORDER_PHASE2, "2002-01-01")
        )
        return self.raw("customer").select(
            F.col("c_custkey").cast("string").alias("pId"), F.inline(spans)
        )

    def activity_responses(self) -> DataFrame:
        """Three surveys per order, all on the order's day."""
        kinds = F.array(*map(F.lit, ("DAILY", "MORNING", "EVENING")))
        return (
            self.raw("orders")
            .select(
                F.col("o_custkey").cast("string").alias("pId"),
                F.to_date("o_orderdate").alias("date"),
                "o_orderkey",
                F.explode(kinds).alias("sId"),
            )
            .select(
                "pId", F.concat_ws("_", F.lit("S"), "sId", "o_orderkey").alias("surveyId"),
                "sId", "date",
            )
        )

    def activity_details(self) -> DataFrame:
        """Order lines as survey answers: endorsed all, planned unless N, completed if F."""
        kinds = F.array_compact(
            F.array(
                F.lit("DAILY"),
                F.when(F.col("l_returnflag") != "N", "MORNING"),
                F.when(F.col("l_linestatus") == "F", "EVENING"),
            )
        )
        score = F.when(F.col("l_linenumber") == 7, -1).otherwise(F.col("l_quantity").cast("int"))
        return (
            self.raw("lineitem")
            .select(
                "l_orderkey", F.col("l_partkey").cast("string").alias("activityId"),
                score.alias("score"), F.explode(kinds).alias("kind"),
            )
            .select(
                F.concat_ws("_", F.lit("S"), "kind", "l_orderkey").alias("surveyId"),
                "activityId", "score",
            )
        )

    # ---- questionnaires ------------------------------------------------------------

    def _blocks(self) -> DataFrame:
        """Events in three ten-day blocks, the timepoints."""
        block = F.floor((F.dayofmonth("date") - 1) / 10).cast("int")
        name = F.get(F.array(*map(F.lit, BLOCK_NAMES)), block)
        return self.events().select(
            F.col("pId").alias("record_id"), "event_type", "value", "k", name.alias("tp")
        )

    def _wide(self, cells: dict[str, Column]) -> DataFrame:
        aggs = [
            F.avg(F.when(F.col("tp") == tp, value)).alias(f"{name}_{tp}")
            for name, value in cells.items()
            for tp in BLOCK_NAMES
        ]
        return self._blocks().groupBy("record_id").agg(*aggs)

    def scores_wide(self) -> DataFrame:
        kind, value = F.col("event_type"), F.col("value")
        return self._wide(
            {
                "cesd_score": value,
                "peat_score": F.when(kind == "click", value),
                "sip_score": F.when(kind == "view", F.col("k").cast("double")),
            }
        )

    def promis_wide(self) -> DataFrame:
        """T-scores of eight domains; the raw sums beside them must be filtered away."""
        value, k = F.col("value"), F.col("k")
        cells = {
            f"promis_{d}_t_default": F.when(k % 8 == i, 40 + value / 10)
            for i, d in enumerate(DOMAINS)
        }
        cells["promis_pf_raw_default"] = value
        return self._wide(cells)

    def pain_wide(self) -> DataFrame:
        return self._wide({"global07": F.when(F.col("k") % 11 < 10, F.col("k") % 11)})

    # ---- demographics from customers -----------------------------------------------

    def demographics(self) -> dict[str, DataFrame]:
        """Two cohorts with unequal and unevenly spelt columns."""
        c = F.col("c_custkey")

        def bit(i: int) -> Column:
            return F.shiftright(c, i).cast("int") % 2

        people = self.raw("customer").select(
            c.cast("string").alias("record_id"),
            (c % 2).alias("cohort_no"),
            (F.lit(20.0) + c % 60).alias("age"),
            (c % 3 + 1).cast("int").alias("gender"),
            (c % 5).cast("int").alias("marital"),
            (c % 7).cast("int").alias("employment"),
            (c % 6 + 1).cast("int").alias("education"),
            (c % 4 + 1).cast("int").alias("cancer_status"),
            (c % 5 + 1).cast("int").alias("cancer_category"),
            *[bit(i).alias(f"race___{i + 1}") for i in range(6)],
            *[bit(i + 1).alias(f"living___{i + 1}") for i in range(4)],
            *[bit(i + 2).alias(f"cancer_treatment___{i + 1}") for i in range(6)],
            F.when(c % 11 != 0, (F.lit(2015) + c % 12)).cast("int").alias("year_diag"),
            (c % 13).cast("int").alias("month_diag"),
            (c % 31 + 1).cast("int").alias("day_diag"),
            F.make_timestamp_ntz(
                F.lit(2024), (c % 12 + 1).cast("int"), F.lit(15), F.lit(9), F.lit(30), F.lit(0)
            ).alias("demo_datetime"),
            F.round(F.col("c_acctbal") / 1000, 0).alias("dhls"),
        )
        shared = [
            "record_id", "age", "gender", "marital", "employment", "education", "cancer_status",
            *[f"race___{i + 1}" for i in range(6)], *[f"living___{i + 1}" for i in range(4)],
            *[f"cancer_treatment___{i + 1}" for i in range(6)], "demo_datetime",
        ]

        def parts(spelling: str) -> list[Column]:
            return [
                F.col(f"{u}_diag").alias(f"{u}_{spelling}{stage}")
                for stage in ("", "_stage4")
                for u in ("year", "month", "day")
            ] + [F.col(f"{u}_diag").alias(f"{u}_treatment") for u in ("year", "month", "day")]

        first = people.filter(F.col("cohort_no") == 0).select(
            *shared, *parts("diganosed"),
            F.col("cancer_category").alias("cancer_type_participant"),
            F.col("dhls").alias("dhl_score_bl"),
        )
        second = people.filter(F.col("cohort_no") == 1).select(
            *shared, *parts("diagnosed"),
            F.col("cancer_category").alias("cancer_category_participant"),
            F.col("dhls").alias("dhlsscore"),
            (F.col("cancer_category") % 2).alias("hispanic"),
        )
        return {"phase0": first, "phase1": second}

    def feedback0(self) -> DataFrame:
        """0-10 ratings, one customer per row."""
        c, names = F.col("c_custkey"), (
            "app_difficulty_num", "app_pleasantness_num", "app_burden_num",
            "willingness_participate_num", "willingness_recommend_num",
        )
        rating = [
            F.when(c % 17 != i, (c * (i + 3) + i) % 11).cast("double").alias(n)
            for i, n in enumerate(names)
        ]
        return self.raw("customer").select(c.cast("string").alias("record_id"), *rating)

    def feedback1(self) -> DataFrame:
        c = F.col("c_custkey")
        names = (
            "app_interest_self", "app_interest_score_friend", "study_value_score_phase1evening",
            "study_value_score_calendar", "study_value_score_report", "study_value_score_review",
            "study_value_score_phase2morning", "study_value_score_phase2evening",
            "data_sharing_providers_score",
        )
        return self.raw("customer").select(
            c.cast("string").alias("record_id"),
            F.when(c % 13 != 0, c % 2).alias("data_sharing_others_score"),
            *[(c % (i + 3)).cast("int").alias(f"sus{i + 1}") for i in range(3)],
            F.lit(1).alias("sus_answered_eos"),
            (c % 41 * 2.5).alias("sus_score_eos"),
            *[
                F.when(c % 19 != i, (c * (i + 2) + i) % 11).cast("double").alias(n)
                for i, n in enumerate(names)
            ],
        )

    # ---- devices -------------------------------------------------------------------

    def participants(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_custkey").cast("string").alias("label"),
            F.lit(PHASE1[0]).cast("date").alias("start_date"),
            F.lit(PHASE2[1]).cast("date").alias("end_date"),
        )

    def devices(self) -> DataFrame:
        return self.raw("orders").select(
            F.concat(F.lit("D"), F.col("o_orderkey")).alias("id"),
            F.col("o_custkey").alias("participant_id"),
        )

    def minutes(self) -> DataFrame:
        """Each event is one wearable sample; several may fall into one minute."""
        v, k = F.col("value"), F.col("k")
        band = lambda names: F.get(F.array(*map(F.lit, names)), k % 4)
        return self.events().select(
            F.concat(F.lit("p"), "pId").alias("pid"),
            "ts",
            F.when(k % 10 != 0, 50 + k).cast("double").alias("heartrate"),
            band(("outofrange", "fatburn", "cardio", "peak")).alias("hr_zone"),
            (v * 4).cast("int").alias("steps"),
            (v / 10).alias("calories"),
            (k / 20).alias("mets"),
            band(("sedentary", "lightlyactive", "fairlyactive", "veryactive")).alias(
                "activity_level"
            ),
        )

    def dense_minutes(self) -> DataFrame:
        """Each event as a run of minutes, so that bouts and cadences have something to find."""
        v, k = F.col("value"), F.col("k")
        start = F.date_trunc("minute", F.col("ts"))
        span = F.sequence(F.lit(0), k % 20)
        return (
            self.events()
            .select(
                F.concat(F.lit("p"), "pId").alias("pid"), start.alias("t0"), v.alias("v"),
                k.alias("k"), F.explode(span).alias("i"),
            )
            .select(
                "pid",
                (F.col("t0") + F.make_dt_interval(mins=F.col("i"))).alias("ts"),
                F.lit(None).cast("double").alias("heartrate"),
                F.lit(None).cast("string").alias("hr_zone"),
                F.when((F.col("k") + F.col("i")) % 4 != 0, (F.col("v") + F.col("i")).cast("int"))
                .otherwise(0).alias("steps"),
                (F.col("v") / 10).alias("calories"),
                ((F.col("k") + F.col("i")) % 6).cast("double").alias("mets"),
                F.get(
                    F.array(*map(F.lit, ("sedentary", "lightlyactive", "fairlyactive", "veryactive"))),
                    F.col("k") % 4,
                ).alias("activity_level"),
            )
        )

    def sleep_episodes(self) -> DataFrame:
        """Each event is a sleep episode that starts at its time."""
        k, v = F.col("k"), F.col("value")
        bed = (F.lit(60) + k * 5).cast("int")
        return self.events().select(
            F.concat(F.lit("p"), "pId").alias("pid"),
            F.col("ts").alias("start_ts"),
            (F.col("ts") + F.make_dt_interval(mins=bed)).alias("end_ts"),
            F.when(F.col("event_type") == "click", "main").otherwise("nap").alias("type"),
            (50 + k % 50).cast("double").alias("efficiency"),
            (bed * 0.75).alias("minutes_asleep"),
            (bed * 0.125).alias("minutes_awake"),
            (k % 7).cast("double").alias("minutes_to_fall_asleep"),
            (k % 5).cast("double").alias("minutes_after_wakeup"),
            bed.cast("double").alias("minutes_in_bed"),
        )

    def sleep_stages(self) -> DataFrame:
        """Each event is a stage record: level by kind of event, duration by its number."""
        level = (
            F.when(F.col("event_type") == "click", "wake")
            .when(F.col("event_type") == "view", "deep")
            .when(F.col("event_type") == "purchase", "light")
            .when(F.col("event_type") == "signup", "rem")
            .otherwise("asleep")
        )
        k = F.col("k")
        return self.events().select(
            F.concat(F.lit("p"), "pId").alias("pid"),
            "ts",
            ((k + 1) * 30).cast("int").alias("duration_s"),
            level.alias("level"),
            F.when(k % 2 == 0, "main").otherwise("nap").alias("type"),
        )

    def csv_export(self) -> str:
        """Customers written as CSV files, the path of which it returns.

        Names hold quotes, commas and line breaks; some balances are missing or no numbers, and
        some records have a cell too many.
        """
        key = F.col("c_custkey")
        name = F.when(key % 4 == 0, F.concat(F.lit('say "hi", '), "c_name")).when(
            key % 4 == 1, F.concat("c_name", F.lit("\nand more"))).otherwise(F.col("c_name"))
        balance = F.when(key % 11 == 0, "oops").when(key % 13 == 0, "NA").otherwise(F.col("c_acctbal").cast("string"))
        cells = [F.format_string("%08d", key), F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"')), balance]
        line = F.concat(F.concat_ws(",", *cells), F.when(key % 17 == 0, ",more").otherwise(""))
        lines = self.raw("customer").select((key % FILES).cast("int").alias("file"), F.lit(1).alias("place"), line.alias("value"))
        heads = self.spark.range(FILES).select(
            F.col("id").cast("int").alias("file"), F.lit(0).alias("place"), F.lit("record_id,name,balance").alias("value"))
        path = f"{scratch(self.spark)}/export-{uuid.uuid4().hex}"
        ordered = lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "place")
        ordered.select("file", "value").write.partitionBy("file").text(path)
        return f"{path}/file=*"

    def faulty_documents(self) -> DataFrame:
        """The documents of `raw_documents`, some broken off and some without samples."""
        k = F.col("k")
        whole = F.to_json(F.struct(
            F.col("date").cast("string").alias("date"),
            F.array(F.struct(F.date_format("ts", "HH:mm:ss").alias("time"), k.alias("steps"))).alias("dataset")))
        text = F.when(k % 7 == 0, F.substring(whole, 1, 25)).when(
            k % 7 == 1, F.to_json(F.struct(F.col("date").cast("string").alias("date")))).otherwise(whole)
        return self.events().select(F.concat(F.lit("p"), "pId").alias("pid"), text.alias("json"))

    def raw_documents(self) -> DataFrame:
        """One JSON document per event, holding its minute sample."""
        sample = F.struct(
            F.date_format("ts", "HH:mm:ss").alias("time"),
            F.col("value").alias("heartrate"),
            F.col("k").alias("steps"),
        )
        document = F.struct(
            F.col("date").cast("string").alias("date"), F.array(sample).alias("dataset")
        )
        return self.events().select(
            F.concat(F.lit("p"), "pId").alias("pid"), F.to_json(document).alias("json")
        )
