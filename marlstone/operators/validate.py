"""Checks of item records, and coverage of a corpus against its goal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import url as U
from marlstone.functions.columns import filled
from marlstone.plans.schemas import ELEMENT_ROLES, IMPLEMENTATIONS, NAME_SOURCES, QUALITIES, SECTORS, STATUSES, SUBTYPES, VERDICTS, Settings


def _no(test: Column) -> Column:
    """True where the test is not plainly met."""
    return ~F.coalesce(test, F.lit(False))


def rules(web: Column | None = None, host: Column | None = None) -> list[tuple[str, Column]]:
    """(name of the rule, where it is broken), one for each of the 33 predicates of a single record.

    Records carry `_keys`, the keys that were present, where null and absent differ.
    """
    c = F.col
    web = U.is_web_col(c("page_url")) if web is None else web
    host = U.domain_col(c("page_url")) if host is None else host
    has = lambda k: F.array_contains("_keys", k)
    inline = c("implementation") == "inline-svg"
    outside = c("implementation").isin("img", "input-image", "area")
    reviewed = _no(c("status") == "unreviewed")
    ready = F.coalesce(c("status") == "ready", F.lit(False))
    space_form = has("image_coord_space") & (c("image_coord_space").isNull() | c("image_coord_space").rlike(r"^[1-9]\d*x[1-9]\d*$"))
    known = c("subtype").isin(*SUBTYPES)
    category = F.create_map(*(F.lit(x) for pair in SUBTYPES.items() for x in pair))
    page_ok, domain_ok = F.coalesce(web, F.lit(False)), filled(c("domain"))
    url_ok = c("image_url").rlike("^(?i)https?://[^/?#]") | c("image_url").startswith("data:")
    return [
        ("id_form", _no(c("id").rlike(r"^fi-\d{4,}$"))),
        ("status_value", _no(c("status").isin(*STATUSES))),
        ("page_url_web", ~page_ok),
        ("domain_filled", ~domain_ok),
        ("domain_is_host", page_ok & domain_ok & _no(c("domain") == host)),
        ("sector_filled", ~filled(c("sector"))),
        ("implementation_value", _no(c("implementation").isin(*IMPLEMENTATIONS.values()))),
        ("element_role_value", _no(c("element_role").isin(*ELEMENT_ROLES))),
        ("image_url_needed", F.coalesce(outside, F.lit(False)) & _no(url_ok)),
        ("image_url_unneeded", F.coalesce(inline, F.lit(False)) & c("image_url").isNotNull()),
        ("image_svg_needed", F.coalesce(inline, F.lit(False)) & ~filled(c("image_svg"))),
        ("image_svg_document", F.coalesce(inline, F.lit(False)) & filled(c("image_svg")) & _no(c("image_svg").startswith("<svg") & F.contains("image_svg", F.lit("xmlns=")))),
        ("image_svg_unneeded", _no(inline) & (c("image_svg").isNotNull() | ~has("image_svg"))),
        ("coord_space_form", ~space_form),
        ("coord_space_area", space_form & c("image_coord_space").isNotNull() & _no(c("element_role") == "area")),
        ("element_html_filled", ~filled(c("element_html"))),
        ("element_html_tag", filled(c("element_html")) & ~c("element_html").startswith("<")),
        ("surrounding_text_string", c("surrounding_text").isNull()),
        ("observed_alt_present", ~has("observed_alt")),
        ("accessible_name_filled", ~filled(c("accessible_name"))),
        ("name_source_value", _no(c("accessible_name_source").isin(*NAME_SOURCES))),
        ("subtype_value", _no(known)),
        ("category_of_subtype", F.coalesce(known, F.lit(False)) & _no(c("category") == F.try_element_at(category, c("subtype")))),
        ("retrieved_form", _no(c("retrieved").rlike(r"^\d{4}-\d{2}-\d{2}$"))),
        ("ready_file", ready & ~filled(c("image_file"))),
        ("ready_sha256", ready & _no(c("image_sha256").rlike("^[0-9a-f]{64}$"))),
        ("image_file_blank", ~ready & F.coalesce(c("image_file") == "", F.lit(False))),
        ("reviewed_verdict", reviewed & _no(c("review_verdict").isin(*VERDICTS))),
        ("reviewed_reason", reviewed & ~filled(c("review_reason"))),
        ("reviewed_quality", reviewed & _no(c("alt_quality").isin(*QUALITIES))),
        ("ready_good", ready & _no(c("alt_quality") == "good")),
        ("ready_keep", ready & _no(c("review_verdict") == "keep")),
        *((f"unreviewed_{k}", ~reviewed & c(k).isNotNull()) for k in ("review_verdict", "review_reason", "alt_quality")),
    ]


def broken(items: DataFrame, tests: list[tuple[str, Column]], *keep: Column | str) -> DataFrame:
    """`keep` and `problem`: a row for every test that a record fails, in the order of the tests."""
    return items.select(*keep, F.explode(F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests)))).alias("problem"))


def repeats(items: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows whose key came before, with `first`, the first of `order` at its first place. `order` is unique in a key.

    The first is a minimum, combined before the shuffle, and meets the rows in a join, which Spark splits where one key
    has very many.
    """
    least = items.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min(F.struct(*order)).alias("_least"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    rows = items.join(least, same).where(F.struct(*order) > F.col("_least"))
    return rows.withColumn("first", F.col("_least")[order[0]]).select(*items.columns, "first")


def check(items: DataFrame) -> DataFrame:
    """(line, id, problem): every rule that a record breaks, and repeated ids with the line of the first."""
    if "_keys" not in items.columns:
        items = items.withColumn("_keys", F.array(*(F.lit(c) for c in items.columns)))
    items = items.withColumn("_web", U.is_web_col("page_url")).withColumn("_host", U.domain_col("page_url"))
    single = broken(items, rules(F.col("_web"), F.col("_host")), F.col("pos").alias("line"), "id")
    again = repeats(items.where("id is not null").select(F.col("pos").alias("line"), "id"), ["id"], ["line"])
    return single.unionByName(again.select("line", "id", F.concat(F.lit("duplicate_id_of_line_"), "first").alias("problem")))


def tallies(items: DataFrame, fields: tuple[str, ...] = ("sector", "subtype", "domain", "page_url")) -> DataFrame:
    """(field, value, n) of several fields in one scan."""
    # Which fields a row of the grouping sets leaves out: bit k for the k-th from the end.
    ids = {(1 << len(fields)) - 1 - (1 << (len(fields) - 1 - k)): f for k, f in enumerate(fields)}
    sets = items.groupingSets([[F.col(f)] for f in fields], *(F.col(f) for f in fields)).agg(F.grouping_id().alias("_g"), F.count("*").alias("n"))
    name = F.create_map(*(F.lit(x) for pair in ids.items() for x in pair))
    return sets.select(name[F.col("_g").cast("int")].alias("field"), F.coalesce(*(F.when(F.col("_g") == g, F.col(f)) for g, f in ids.items())).alias("value"), "n")


def coverage(items: DataFrame, settings: Settings = Settings(), status: str | None = None) -> DataFrame:
    """(kind, value, n, bound): shortfalls and excesses, of all records or of those of one status."""
    s = settings
    t = tallies(items if status is None else items.where(F.col("status") == status))
    expected = items.sparkSession.createDataFrame([("sector", v) for v in SECTORS] + [("subtype", v) for v in SUBTYPES], "field string, value string").withColumn("known", F.lit(True))
    t = t.join(expected, ["field", "value"], "full").withColumn("n", F.coalesce("n", F.lit(0)))
    known = F.coalesce("known", F.lit(False))
    of = lambda field: F.col("field") == field
    tests = [
        ("sector_short", of("sector") & known, "<", s.share(s.sector_min_share)),
        ("sector_unknown", of("sector") & ~known, "", None),
        ("sector_over", of("sector"), ">", s.share(s.sector_max_share)),
        ("subtype_short", of("subtype") & known, "<", s.share(s.subtype_min_share)),
        ("domain_over", of("domain"), ">", s.domain_cap()),
        ("page_url_over", of("page_url"), ">", s.per_page),
    ]
    past = lambda sign, bound: F.lit(True) if bound is None else F.col("n") < bound if sign == "<" else F.col("n") > bound
    found = F.array(*(F.when(test & past(sign, bound), F.struct(F.lit(kind).alias("kind"), F.lit(bound).cast("int").alias("bound"))) for kind, test, sign, bound in tests))
    return t.withColumn("x", F.explode(F.array_compact(found))).select("x.kind", "value", "n", "x.bound")


#: Domains and pages that a report lists, the largest first; sectors and sub-types are listed all.
LISTED = 1000


def report(items: DataFrame, settings: Settings = Settings(), listed: int = LISTED) -> DataFrame:
    """One row, one column of JSON: caps, problems, warnings and counts by field (null values under an empty name).

    Of domains and pages the `listed` largest are in it, found task by task first; how many there are is under `distinct`.
    """
    caps = F.create_map(*(F.lit(x) for k, v in {"sectorMin": settings.share(settings.sector_min_share), "sectorMax": settings.share(settings.sector_max_share), "subtypeMin": settings.share(settings.subtype_min_share), "domainMax": settings.domain_cap(), "perPage": settings.per_page}.items() for x in (k, v)))
    every = tallies(items)
    distinct = every.groupBy("field").agg(F.count("*").alias("distinct"))
    nth = F.row_number().over(Window.partitionBy("field").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first()))
    large = every.where(F.col("field").isin("domain", "page_url")).withColumn("nth", nth).where(F.col("nth") <= listed).drop("nth")
    shown = every.where(~F.col("field").isin("domain", "page_url")).unionByName(large)
    counts = shown.groupBy("field").agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce("value", F.lit("")), "n"))).alias("counts")).join(distinct, "field")
    by = counts.agg(F.map_from_entries(F.collect_list(F.struct("field", "counts"))).alias("by"), F.map_from_entries(F.collect_list(F.struct("field", "distinct"))).alias("distinct"))
    problems = check(items).agg(F.count("*").alias("problems"))
    warnings = coverage(items, settings).agg(F.count("*").alias("warnings"))
    one = F.lit(1).alias("_one")
    joined = by.select("by", "distinct", one).join(problems.select("problems", one), "_one").join(warnings.select("warnings", one), "_one")
    return joined.select(F.to_json(F.struct(F.lit(settings.goal).alias("goal"), caps.alias("caps"), "problems", "warnings", "distinct", "by")).alias("report"))
