"""Combined LCA + cost results and the portfolio summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.functions.numbers import is_missing, swiss_number
from graustein.operators.cost import COST_COMPONENT
from graustein.session import written_copy

SUMMARY_MEASURES = (("total_cost", "total_cost", 2), ("total_co2_emission", "gwp_absolute", 3),
                    ("total_primary_energy", "penr_absolute", 3), ("total_ubp", "ubp_absolute", 0))

# The report's line texts (labels and units; a blank line before both titles).
REPORT_TITLE = "\nSummary Report:"
REPORT_LINES = (("total_cost", "Total Cost: {} Chf"),
                ("total_co2_emission", "Total CO₂ Emissions: {} kg CO₂-eq"),
                ("total_primary_energy", "Total Primary Energy (non-renewable): {} kWh oil-eq"),
                ("total_ubp", "Total UBP: {}"))
FAILED_TITLE = "\nFailed Components:"


def lca_rows_for_union(lca: DataFrame) -> DataFrame:
    return lca.select("project_id", F.col("element_id").alias("guid"), F.col("material_name").alias("material"),
                      "ebkp_h", "gwp_absolute", "penr_absolute", "ubp_absolute", "failed",
                      F.col("error_message").alias("error"), F.lit("lca").alias("source"))


def cost_rows_for_union(cost: DataFrame) -> DataFrame:
    return cost.select("project_id", "guid", F.lit(COST_COMPONENT).alias("material"), "ebkp_h", "total_cost",
                       "failed", "error", F.lit("cost").alias("source"))


def combine_results(lca: DataFrame, cost: DataFrame) -> DataFrame:
    """LCA and cost components as one flat component table."""
    return lca_rows_for_union(lca).unionByName(cost_rows_for_union(cost), allowMissingColumns=True)


def _counts_per_guid(lca: DataFrame, cost: DataFrame) -> DataFrame:
    """(project_id, guid, n_lca, f_lca, n_cost, f_cost): components and failed ones of both kinds, a row per cost row."""
    lca_g = (lca.groupBy("project_id", F.col("element_id").alias("guid"))
             .agg(F.count(F.lit(1)).alias("n_lca"), F.count_if("failed").alias("f_lca")))
    cost_g = cost.select("project_id", "guid", F.lit(1).alias("n_cost"), F.col("failed").cast("int").alias("f_cost"))
    return lca_g.join(cost_g, ["project_id", "guid"], "full").select(
        "project_id", "guid", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_lca", "f_lca", "n_cost", "f_cost")))


def combined_per_guid(lca: DataFrame, cost: DataFrame) -> DataFrame:
    """Per guid the merged component count and ``shared_guid`` = OR of the
    inputs' flags (an LCA element is shared when it has > 1 component; cost never is)."""
    return _counts_per_guid(lca, cost).select("project_id", "guid", (F.col("n_lca") + F.col("n_cost")).alias("n_components"),
                                              (F.col("f_lca") + F.col("f_cost")).alias("n_failed"), (F.col("n_lca") > 1).alias("shared_guid"))


def combined_rows(lca: DataFrame, cost: DataFrame) -> DataFrame:
    """U1 + A9: the flat component rows with their guid's ``shared_guid``."""
    shared = combined_per_guid(lca, cost).select("project_id", "guid", "shared_guid")
    return combine_results(lca, cost).join(shared, ["project_id", "guid"], "left")


NEST = 1000  # components in a chunk, about
MET = 20 * NEST  # components of a guid that may meet in one group


def _flags_by_source(n_lca, n_cost) -> list:
    """A guid's flags and how often it has each, from its components: those that the rows of ``_counts_per_guid`` give,
    a row per cost row, where a guid or project that is null never meets its counterpart."""
    alone, many, once = F.col("_id.project_id").isNull() | F.col("_id.guid").isNull(), (n_lca > 1).cast("int"), F.greatest(n_cost, F.lit(1))
    return [(False, F.when(alone, n_cost + (n_lca == 1).cast("int")).otherwise((1 - many) * once)), (True, F.when(alone, many).otherwise(many * once))]


def nested(rows: DataFrame, shared: DataFrame | None = None, order: str = "material", chunk: int = NEST, met: int = MET,
           by_source: bool = False) -> DataFrame:
    """One record per (project_id, guid) with its components in a list; a guid with more than
    ``chunk`` components becomes several numbered records. (project_id, guid, shared_guid, n_components,
    chunk, n_chunks, components); a chunk's components are sorted by ``order``.

    The component rows are shuffled once: a guid's components meet in one group, are sorted and cut into
    even chunks. Only guids with more than ``met`` components, at most one in so many rows, are found
    beforehand by a map-side aggregate and dealt over several groups by the components' hashes, so a guid
    with a third of all rows is nested by many tasks and no group is much larger than ``met``. Their equal
    components are counted first and numbered, so that they don't meet in one group. ``shared``
    (project_id, guid, shared_guid) gives the flag; without it a guid with more than one component is shared, or
    (``by_source``, rows of ``combine_results``) one with more than one LCA component."""
    key = ["project_id", "guid"]
    values = [c for c in rows.columns if c not in (*key, "shared_guid")]
    fields = [order, *(c for c in values if c != order)]
    id_of = F.struct(*key).alias("_id")  # equal also where an id is null
    of_lca = F.count_if(F.col("source") == "lca") if by_source else F.lit(None).cast("long")
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), of_lca.alias("_n_lca"))
    large = sizes.filter(F.col("_n") > met).select(id_of, "_n", "_n_lca")
    large = written_copy(large, "large_guids")
    none_large, large = large.isEmpty(), F.broadcast(large)
    groups = F.least(F.ceil(F.col("_n") / met), F.ceil(F.col("_n") / chunk))
    one, component = F.lit(0).cast("long"), F.struct(*fields).alias("_c")
    few = rows.select(id_of, component)
    few = (few if none_large else few.join(large, "_id", "left_anti")).select("_id", one.alias("_group"), "_c")
    dealt = few
    if not none_large:
        many = rows.withColumn("_id", id_of).join(large, "_id").groupBy("_id", "_n", *values).agg(F.count(F.lit(1)).alias("_copies"))
        many = many.select("_id", "_n", component, "_copies")
        many = many.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(
            "_id", F.pmod(F.xxhash64("_c", "_copy"), groups).alias("_group"), "_c")
        dealt = dealt.unionByName(many)
    listed = [F.collect_list("_c").alias("_c")]
    if shared is not None:  # the flags of a guid meet its components, in each of its groups
        flags = shared.select(id_of, F.coalesce("shared_guid", F.lit(False)).alias("_flag")).join(large, "_id", "left").withColumn(
            "_group", F.explode(F.sequence(one, F.coalesce(groups, F.lit(1)) - 1)))
        dealt = dealt.withColumn("_flag", F.lit(None).cast("boolean")).unionByName(
            flags.withColumn("_c", F.lit(None).cast(few.schema["_c"].dataType)).select("_id", "_group", "_c", "_flag"))
        listed.append(F.collect_list("_flag").alias("_flags"))
    dealt = dealt.groupBy("_id", "_group").agg(*listed)
    # a row per large guid
    dealt = dealt.withColumns({"_n": F.lit(None).cast("long"), "_n_lca": F.lit(None).cast("long")}) if none_large else dealt.join(large, "_id", "left")
    size = F.size("_c").cast("long")
    dealt = dealt.filter(size > 0).withColumn("n_components", F.coalesce("_n", size)).withColumn("n_chunks", F.ceil(F.col("n_components") / chunk))
    if shared is None and not by_source:
        flagged = dealt.withColumn("shared_guid", F.col("n_components") > 1)
    else:  # a guid that has a flag several times has its components as often
        if by_source:
            dealt = dealt.withColumn("_n_lca", F.coalesce("_n_lca", F.size(F.filter("_c", lambda c: c["source"] == "lca"))).cast("int"))
            times = _flags_by_source(F.col("_n_lca"), F.col("n_components").cast("int") - F.col("_n_lca"))
        else:
            times = [(v, F.size(F.filter("_flags", lambda f: f == F.lit(v)))) for v in (False, True)]  # noqa: B023
        options = F.filter(F.array(*(F.struct(F.lit(v).alias("flag"), n.alias("times")) for v, n in times)), lambda o: o["times"] > 0)
        if not by_source:
            options = F.when(F.size("_flags") == 0, F.array(F.struct(F.lit(False).alias("flag"), F.lit(1).alias("times")))).otherwise(options)
        flagged = dealt.withColumn("_o", F.explode(options)).withColumn("shared_guid", F.col("_o.flag")).withColumn(
            "_c", F.when(F.col("_o.times") == 1, F.col("_c")).otherwise(F.flatten(F.array_repeat("_c", F.col("_o.times")))))
    # group g of G has the chunks g, g + G, g + 2 G, ...
    all_groups = F.coalesce(groups, F.lit(1))
    own = F.ceil((F.col("n_chunks") - F.col("_group")) / all_groups)
    begin = lambda i: F.floor(i * F.size("_sorted") / F.col("_own")).cast("int")
    parts = F.transform(F.sequence(one, F.col("_own") - 1), lambda i: F.struct(
        (F.col("_group") + i * F.col("_groups")).alias("chunk"), F.slice("_sorted", begin(i) + 1, begin(i + 1) - begin(i)).alias("components")))
    cut = flagged.withColumn("_sorted", F.array_sort("_c")).withColumn("_own", own).withColumn("_groups", all_groups).select(
        "_id.*", "shared_guid", "n_components", "n_chunks", F.explode(F.filter(parts, lambda p: F.size(p["components"]) > 0)).alias("_p"))
    return cut.select(*key, "shared_guid", "n_components", "_p.chunk", "n_chunks", "_p.components")


def lca_nested(lca: DataFrame, chunk: int = NEST) -> DataFrame:
    """The LCA results as one record per element; a failed component carries its error only."""
    rows = lca.select("project_id", F.col("element_id").alias("guid"), F.col("material_name").alias("material"), F.col("kbob_uuid").alias("mat_kbob"),
                      "kbob_material_name", "volume", "density", "amortization", F.when(~F.col("failed"), F.col("ebkp_h")).alias("ebkp_h"),
                      "gwp_absolute", "gwp_relative", "penr_absolute", "penr_relative", "ubp_absolute", "ubp_relative",
                      "failed", F.col("error_message").alias("error"))
    return nested(rows, chunk=chunk)


def combined_nested(lca: DataFrame, cost: DataFrame, chunk: int = NEST) -> DataFrame:
    """LCA and cost components of each guid in one record; ``shared_guid`` is the OR of both. Both are
    computed once: their rows are written, then counted and nested."""
    return nested(written_copy(combine_results(lca, cost), "components", compression="zstd"), chunk=chunk, by_source=True)


def summarize(combined: DataFrame, by: list[str] | None = None, count_failed: bool = False) -> DataFrame:
    """A5: totals over non-failed components; null or NaN values count as 0.

    Sums are exact decimals of the rounded component values (order-independent).
    ``count_failed`` adds ``n_failed`` (failed components), computed in the same pass."""
    ok = ~F.col("failed")
    aggs = []
    for out, src, digits in SUMMARY_MEASURES:
        v = F.col(src) if src in combined.columns else F.lit(None).cast("double")
        aggs.append(F.coalesce(F.sum(F.when(ok & ~is_missing(v), v.cast(f"decimal(38,{digits})"))), F.lit(0))
                    .cast("double").alias(out))
    if count_failed:
        aggs.append(F.count_if(F.col("failed")).alias("n_failed"))
    source = combined if count_failed else combined.filter(ok)
    return source.groupBy(*(by or [])).agg(*aggs)


def failed_components(combined: DataFrame) -> DataFrame:
    """The failed components (a DataFrame, never collected)."""
    return combined.filter(F.col("failed")).select("project_id", "guid", "material", "ebkp_h", "error")


def formatted_summary(summary: DataFrame) -> DataFrame:
    """H9: the four totals in Swiss number style next to the numbers."""
    extra = [swiss_number(F.col(out)).alias(f"{out}_text") for out, _, _ in SUMMARY_MEASURES]
    return summary.select("*", *extra)


def report_lines(summary: DataFrame, failed: DataFrame) -> DataFrame:
    """K6: the text report as ordered lines (``section``, ``sort_key``, ``line``).

    The header and the four totals come from the one-row summary in a single pass
    (one row exploded into five lines); the "Failed Components:" title appears when the
    summary counted failures (``n_failed`` column, see ``summarize``) or, without it, when
    ``failed`` has a row; then one line per failed component, keyed by guid and material.
    Written with ``sinks.write_report``."""
    s = formatted_summary(summary)
    header = [F.struct(F.lit(0).alias("section"), F.lit(REPORT_TITLE).alias("line"))]
    for i, (name, text) in enumerate(REPORT_LINES, start=1):
        before, after = text.split("{}")
        header.append(F.struct(F.lit(i).alias("section"),
                               F.concat(F.lit(before), F.col(f"{name}_text"), F.lit(after)).alias("line")))
    if "n_failed" in s.columns:
        header.append(F.when(F.col("n_failed") > 0, F.struct(F.lit(5).alias("section"), F.lit(FAILED_TITLE).alias("line"))))
        head = s.select(F.explode(F.filter(F.array(*header), lambda x: x.isNotNull())).alias("h"))
    else:
        head = s.select(F.explode(F.array(*header)).alias("h")).unionByName(
            failed.limit(1).select(F.struct(F.lit(5).alias("section"), F.lit(FAILED_TITLE).alias("line")).alias("h")))
    head = head.select(F.col("h.section").alias("section"), F.lit("").alias("sort_key"), F.col("h.line").alias("line"))
    na = F.lit("N/A")
    body = failed.select(
        F.lit(6).alias("section"),
        F.concat_ws("\u0000", F.coalesce("guid", F.lit("")), F.coalesce("material", F.lit(""))).alias("sort_key"),
        F.concat(F.lit("- GUID: "), F.coalesce(F.col("guid"), na), F.lit(", eBKP-H: "), F.coalesce(F.col("ebkp_h"), na),
                 F.lit(", Error: "), F.coalesce(F.col("error"), na)).alias("line"))
    return head.unionByName(body)
