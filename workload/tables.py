"""The given tables, and raw text staging tables derived from all of their rows.

Orders stand for enrolments (customer = student, priority = module, half-year =
presentation), their lines for clicks and assessment results. The text carries
padding, ``?`` markers, blanks and a nonstandard label, so that cleaning has
work to do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import coded
from tallyframe.plans import clean
from tallyframe.session import materialise

# Fixed values of the binding: activity names by line number, assessments by return flag.
ACTIVITIES = {1: "page", 2: "page", 3: "quiz", 4: "forum", 5: "video", 6: "file", 7: "home"}
ASSESSMENT_CODE = {"A": 1, "N": 2, "R": 3}
ASSESSMENT_TYPE = {"A": "TMA", "N": "CMA", "R": "Exam"}
ASSESSMENT_DATE = {"A": "100", "N": " 200 ", "R": "?"}
ASSESSMENT_WEIGHT = {"A": "20.5", "N": "0", "R": "100"}


CONTEXT = ["code_module", "code_presentation"]
#: What several staging tables are made of.
SHARED = ("_enrolled", "_lines")


class Plans(Mapping):
    """Named plans, each built when first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[Plans], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return (name for name in self._builders if not name.startswith("_"))

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def build(self, name: str, plans: Plans) -> DataFrame:
        """The plan ``name`` of these, over the tables of ``plans``."""
        return self._builders[name](plans)

    def also(self, builders: Mapping[str, Callable[[Plans], DataFrame]]) -> Plans:
        return Plans({**self._builders, **builders})

    def written(self, *names: str) -> Plans:
        """Plans in which the named tables are written out once, when first used, and all others are made of the written ones."""
        return self.also({n: lambda t, n=n: materialise(self.build(n, t), n.strip("_")) for n in names})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as a click log: day offsets from a start, cents as clicks."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.datediff(F.col("ts").cast("date"), F.lit("2024-01-08").cast("date")).cast("bigint").alias("day"),
        F.round(F.col("value") * 100).cast("bigint").alias("clicks"),
    )


def enrolments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a module, a presentation and the day within it."""
    date = F.col("o_orderdate").cast("date")
    year, first_half = F.year(date), F.month(date) <= 6
    level = F.substring("o_orderpriority", 1, 1)
    start = F.make_date(year, F.when(first_half, 2).otherwise(9), F.lit(1))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("id_student"),
        "o_orderstatus",
        "o_totalprice",
        F.repeat(F.translate(level, "12345", "ABCDE"), F.lit(3)).alias("code_module"),
        F.concat(year.cast("string"), F.when(first_half, "B").otherwise("J")).alias("code_presentation"),
        ((year - 1990) * 20 + F.when(first_half, 0).otherwise(10) + level.cast("int")).cast("bigint").alias("context"),
        year.alias("year"),
        F.datediff(date, start).cast("bigint").alias("day"),
    )


def order_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        "l_tax",
        "l_discount",
    )
    return lines.join(orders, "o_orderkey")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _enrolled(t: Plans) -> DataFrame:
    return t["_orders"].groupBy("id_student", *CONTEXT, "year").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("o_orderstatus").alias("status"),
        F.max("o_totalprice").alias("price"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


def _courses(t: Plans) -> DataFrame:
    length = F.when(F.col("code_presentation").endswith("B"), "241").otherwise("269")
    return t["_orders"].select(*CONTEXT).distinct().withColumn("module_presentation_length", length)


def _id_assessment() -> Column:
    return _text(F.col("context") * 10 + coded("l_returnflag", ASSESSMENT_CODE)).alias("id_assessment")


def _assessments(t: Plans) -> DataFrame:
    kinds = t["_lines"].select("context", *CONTEXT, "l_returnflag").distinct()
    return kinds.select(
        *CONTEXT,
        _id_assessment(),
        coded("l_returnflag", ASSESSMENT_TYPE).alias("assessment_type"),
        coded("l_returnflag", ASSESSMENT_DATE).alias("date"),
        coded("l_returnflag", ASSESSMENT_WEIGHT).alias("weight"),
    )


def _vle(t: Plans) -> DataFrame:
    number = F.col("l_linenumber")
    sites = t["_lines"].select("context", *CONTEXT, "l_linenumber").distinct()
    return sites.select(
        _text(F.col("context") * 10 + number).alias("id_site"),
        *CONTEXT,
        coded("l_linenumber", ACTIVITIES).alias("activity_type"),
        F.when(number <= 4, "?").otherwise(_text(number - 4)).alias("week_from"),
        F.when(number <= 4, "?").otherwise(_text(number * 2)).alias("week_to"),
    )


def _student_info(t: Plans) -> DataFrame:
    decile = F.floor((F.col("c_acctbal") + 1000) / 1100)
    band = (
        F.when(decile == 0, "?")
        .when(decile == 1, "10-20")
        .when(decile == 9, "")
        .otherwise(F.concat(_text(decile * 10), F.lit("-"), _text(decile * 10 + 10), F.lit("%")))
    )
    age = F.when(F.col("year") < 1997, "0-35").when(F.col("year") < 2000, "35-55").otherwise("55<=")
    result = (
        F.when(F.col("status") == "F", "Fail")
        .when(F.col("status") == "P", "Withdrawn")
        .when(F.col("price") > 250000, "Distinction")
        .otherwise("Pass")
    )
    return t["_enrolled"].join(t["_people"], F.col("id_student") == F.col("c_custkey")).select(
        F.concat(F.lit(" "), F.col("code_module"), F.lit(" ")).alias("code_module"),
        "code_presentation",
        F.concat(F.lit(" "), _text("id_student")).alias("id_student"),
        F.when(F.col("c_acctbal") < 4500, "F").otherwise("M").alias("gender"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("region"),
        F.col("c_mktsegment").alias("highest_education"),
        band.alias("imd_band"),
        age.alias("age_band"),
        _text(F.col("n") - 1).alias("num_of_prev_attempts"),
        _text(F.col("n") * 30).alias("studied_credits"),
        F.when(F.col("n_regionkey") == 0, "Y").otherwise("N").alias("disability"),
        result.alias("final_result"),
    )


def _student_registration(t: Plans) -> DataFrame:
    return t["_enrolled"].select(
        *CONTEXT,
        _text("id_student").alias("id_student"),
        F.when(F.col("price") > 480000, "?").otherwise(_text(F.col("first_day") - 20)).alias("date_registration"),
        F.when(F.col("status") == "P", _text(F.col("last_day") + 130)).otherwise("?").alias("date_unregistration"),
    )


def _student_assessment(t: Plans) -> DataFrame:
    results = t["_lines"].groupBy("id_student", "context", "l_returnflag").agg(
        F.max("day").alias("day"),
        F.max("quantity").alias("quantity"),
        F.max("l_tax").alias("tax"),
        F.max("l_discount").alias("discount"),
    )
    return results.select(
        _id_assessment(),
        _text("id_student").alias("id_student"),
        _text(F.col("day") + F.col("quantity") * 3).alias("date_submitted"),
        F.when(F.col("tax") > 0.075, "1").otherwise("0").alias("is_banked"),
        F.when(F.col("discount") < 0.02, "?").otherwise(_text(F.col("quantity") * 2)).alias("score"),
    )


def _student_vle(t: Plans) -> DataFrame:
    return t["_lines"].select(
        *CONTEXT,
        _text("id_student").alias("id_student"),
        _text(F.col("context") * 10 + F.col("l_linenumber")).alias("id_site"),
        _text(F.col("day") + F.col("l_linenumber")).alias("date"),
        _text("quantity").alias("sum_click"),
    )


def staging(spark: SparkSession, sf_dir: str) -> Plans:
    """Seven all-text staging tables."""
    nation = lambda: table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return Plans(
        {
            "_orders": lambda t: enrolments(spark, sf_dir),
            "_lines": lambda t: order_lines(spark, sf_dir, t["_orders"]),
            "_people": lambda t: table(spark, sf_dir, "customer").join(nation(), "c_nationkey"),
            "_enrolled": _enrolled,
            "stg_courses": _courses,
            "stg_assessments": _assessments,
            "stg_vle": _vle,
            "stg_student_info": _student_info,
            "stg_student_registration": _student_registration,
            "stg_student_assessment": _student_assessment,
            "stg_student_vle": _student_vle,
        }
    )


def flawed(spark: SparkSession, sf_dir: str) -> Plans:
    """The staging tables with rows that break their rules, all derived from rows of the given tables."""
    good = staging(spark, sf_dir)
    c, lit = F.col, F.lit

    def more(table: str, *rows) -> Callable[[Plans], DataFrame]:
        """Each row of a table, and a changed copy of it for each condition that it meets, in one pass."""

        def build(t):
            df = good.build(table, t)
            copies = [F.struct(*df.columns)]
            for where, changes in rows:
                changes = {k: v if isinstance(v, Column) else lit(v).cast("string") for k, v in changes.items()}
                copies.append(F.when(F.expr(where), F.struct(*[changes.get(k, c(k)).alias(k) for k in df.columns])))
            return df.select(F.inline(F.array_compact(F.array(*copies))))

        return build

    after = lambda name, digits: F.concat(c(name), lit(digits))
    minus = F.concat(lit("-"), F.trim("id_student"))
    return good.also(
        {
            "stg_courses": more(
                "stg_courses",
                ("code_module = 'AAA'", {}),
                ("code_module = 'BBB'", {"code_module": F.lower("code_module"), "code_presentation": after("code_presentation", "X"),
                                         "module_presentation_length": "none"}),
                ("code_module = 'CCC'", {"code_module": "YYY", "module_presentation_length": "0"}),
            ),
            "stg_assessments": more(
                "stg_assessments",
                ("code_module = 'AAA' AND assessment_type = 'Exam'", {}),
                ("code_module = 'BBB' AND assessment_type = 'CMA'",
                 {"id_assessment": after("id_assessment", "7"), "assessment_type": "Essay", "date": "900", "weight": "150"}),
                ("code_module = 'CCC' AND assessment_type = 'TMA'",
                 {"id_assessment": after("id_assessment", "8"), "code_module": "ZZZ", "weight": None}),
            ),
            "stg_vle": more(
                "stg_vle",
                ("code_module = 'AAA' AND activity_type = 'quiz'", {}),
                ("code_module = 'BBB' AND activity_type = 'home'",
                 {"id_site": after("id_site", "7"), "code_module": "ZZZ", "activity_type": None, "week_from": "9", "week_to": "2"}),
            ),
            "stg_student_info": more(
                "stg_student_info",
                ("final_result = 'Distinction'", {}),
                ("final_result = 'Withdrawn'",
                 {"code_module": "ZZZ", "gender": "X", "imd_band": "5-15%", "age_band": "20-30", "num_of_prev_attempts": "-1",
                  "studied_credits": "0", "disability": "Q", "final_result": "Left"}),
                ("age_band = '55<='", {"id_student": minus, "gender": None, "region": None}),
            ),
            "stg_student_registration": more(
                "stg_student_registration",
                ("date_unregistration <> '?' AND code_module = 'AAA'", {}),
                ("date_unregistration <> '?'", {"code_module": "ZZZ", "date_registration": "10", "date_unregistration": "5"}),
            ),
            "stg_student_assessment": more(
                "stg_student_assessment",
                ("is_banked = '1'", {}),
                ("score = '100'", {"id_student": minus, "is_banked": "5", "score": "101"}),
                ("score = '98'", {"id_assessment": after("id_assessment", "99")}),
                ("score = '96'", {"id_student": after("id_student", "0"), "date_submitted": None}),
            ),
            "stg_student_vle": more(
                "stg_student_vle",
                ("sum_click = '50'", {"id_student": minus, "id_site": after("id_site", "9"), "sum_click": "0"}),
                ("sum_click = '49'", {"date": None}),
            ),
        }
    )


def layers(spark: SparkSession, sf_dir: str, stg: Plans | None = None) -> Plans:
    """Staging tables (``stg``, or the derived ones) and the clean tables over them."""
    return (stg or staging(spark, sf_dir)).also(
        {
            "clean_module_presentation": lambda t: clean.clean_module_presentation(t["stg_courses"]),
            "clean_student": lambda t: clean.clean_student(t["stg_student_info"]),
            "clean_registration": lambda t: clean.clean_registration(
                t["stg_student_info"], t["stg_student_registration"]
            ),
            "clean_assessment": lambda t: clean.clean_assessment(t["stg_assessments"]),
            "clean_vle_resource": lambda t: clean.clean_vle_resource(t["stg_vle"]),
            "clean_student_assessment": lambda t: clean.clean_student_assessment(
                t["stg_student_assessment"], t["clean_assessment"]
            ),
            "clean_student_vle_interaction": lambda t: clean.clean_student_vle_interaction(t["stg_student_vle"]),
        }
    )
