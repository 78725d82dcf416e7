"""The evidence report of a release: what the clean table keeps, and what corruption did to it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patina.collection import INDEX, Collection
from patina.operators import audit, compare
from patina.operators.stage import stage

EVIDENCE = "section string, name string, figure string, value double, examples array<bigint>"


def _rows(table: DataFrame, section: str, name: str | Column, figures: Mapping[str, Column], examples: Column | None = None) -> DataFrame:
    """One evidence row for each figure of each row of ``table``."""
    listed = F.array(*[F.struct(F.lit(f).alias("figure"), c.cast("double").alias("value")) for f, c in figures.items()])
    none = F.array().cast("array<bigint>")
    label = F.lit(name) if isinstance(name, str) else name
    return table.select(
        F.lit(section).alias("section"), label.alias("name"), F.explode(listed).alias("f"), (none if examples is None else examples).alias("examples")
    ).select("section", "name", "f.figure", "f.value", "examples")


def evidence_report(
    source: Collection,
    clean: Collection,
    dirty: Collection,
    manifest: DataFrame,
    rules: Mapping[str, Column],
    numeric: Sequence[str],
    broken_by_patches: Column,
    contract: compare.NoveltyContract,
    checks: DataFrame | None = None,
) -> DataFrame:
    """All evidence as (section, name, figure, value, examples).

    * ``clean_rules``: how many clean records break each rule, and the first of them;
    * ``numeric``: minimum, maximum and mean of ``numeric`` paths in source and clean table;
    * ``patches``: how many there are, how many break the rule that they should, and the first that don't;
    * ``untargeted``: records that no patch names and that changed all the same;
    * ``novelty`` and ``overlap``: what the clean table shares with its source;
    * ``validation``: errors and warnings of ``checks``, if given.

    Examples are the ``audit.EVIDENCE_LIMIT`` smallest record indices, found in the same job as the
    counts. An empty manifest has no patches and nothing that fails.
    """
    limit = audit.EVIDENCE_LIMIT
    checked = audit.audit(clean.df, rules)
    first = audit.first_broken(audit.failures(clean.df, rules), clean.count(), limit, ["rule"])
    by_rule = checked.join(first.select("rule", "first"), "rule", "left")
    shown = F.transform(F.coalesce("first", F.array().cast("array<struct<record_index:bigint>>")), lambda s: s["record_index"])
    out = _rows(by_rule, "clean_rules", F.col("rule"), {"checked": F.col("checked"), "failed": F.col("failed")}, shown)

    figures = audit.numeric_evidence(source, clean, numeric)
    out = out.unionByName(
        _rows(figures, "numeric", F.concat_ws(" ", "path", "side"), {c: F.col(c) for c in ("min", "max", "mean")})
    )

    efficacy = stage(audit.patch_efficacy(dirty, manifest, broken_by_patches))  # a row a patch, read twice
    weak = audit.first_broken(efficacy.where(~F.col("passed")), clean.count(), limit)
    counts = efficacy.agg(F.count(F.lit(1)).alias("patches"), F.count_if("passed").alias("passed"))
    both = counts.crossJoin(F.broadcast(weak))
    indices = F.transform("first", lambda s: s[INDEX])
    out = out.unionByName(
        _rows(both, "patches", "efficacy", {"patches": F.col("patches"), "passed": F.col("passed")}, indices)
    )

    rest = compare.untargeted_unchanged(clean, dirty, manifest)
    out = out.unionByName(
        _rows(rest, "untargeted", "records", {"compared": F.col("untargeted_count"), "changed": F.col("changed_count")})
    )
    novel = compare.novelty(source, clean, contract)
    ratios = ("changed_value_ratio", "high_similarity_record_ratio")
    out = out.unionByName(_rows(novel, "novelty", "aligned records", {c: F.col(c) for c in ratios}))
    out = out.unionByName(_rows(compare.row_overlap(source, clean), "overlap", "rows", {"overlap_count": F.col("overlap_count")}))
    if checks is not None:
        status = F.col("status")
        sums = checks.agg(F.count_if(status == "failed").alias("errors"), F.count_if(status == "warning").alias("warnings"))
        out = out.unionByName(_rows(sums, "validation", "checks", {c: F.col(c) for c in ("errors", "warnings")}))
    return out
