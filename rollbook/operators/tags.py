"""Joined tag text per site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook import params as P
from rollbook.functions.windows import one_of
from rollbook.operators.lookup import lookup
from rollbook.schema import SITE


def site_tag_texts(site_tag: DataFrame, tag_type: DataFrame) -> DataFrame:
    """Both joined texts of each site from one pass over its tags.

    ``site_codes``: comma-joined tag descriptions of the site-code group, by tag code then text.
    ``po_usage``: comma-joined usage of the usage tags, by tag code. Duplicates are kept in both.

    Equal entries are counted first, with a partial aggregation, so what is collected per site is
    bounded by the tag dictionary and not by the number of tags; descriptions are one list for each tag, so
    that a tag with several stays one row. A site without entries of a kind has NULL.
    """
    usage = sorted(P.USAGE_BY_TAG)
    in_group = one_of("tag_group", [P.SITE_CODE_GROUP])
    counted = (site_tag.where(f"{in_group} OR {one_of('tag_code', usage)}")
               .groupBy(*SITE, "tag_group", "tag_code").agg(F.expr("count(1) AS n")))
    # NULL descriptions are left out by collect_list; array_join would turn them into empty text.
    names = (tag_type.where(in_group).groupBy("tag_group", "tag_code", "origin")
             .agg(F.expr("collect_list(name) AS names")))
    named = lookup(counted, names, {"tag_group": "tag_group", "tag_code": "tag_code",
                                    "origin": "origin"}, {"names": "names"})
    entry = "struct(tag_code, text, concat(repeat(concat(text, ', '), int(n) - 1), text) AS e)"
    entries = f"transform(coalesce(names, array()), text -> {entry})"
    counts = [f"int(sum(CASE WHEN tag_code = '{c}' THEN n ELSE 0 END)) AS n{c}" for c in usage]
    per_site = named.groupBy(*SITE).agg(
        F.expr(f"array_sort(flatten(collect_list({entries}))).e AS codes"), *map(F.expr, counts))
    texts = ", ".join(f"repeat('{P.USAGE_BY_TAG[c]}, ', n{c})" for c in usage)
    found = f"nullif(concat({texts}), '')"
    # each usage ends in a comma and a blank, of which the last are cut off
    return per_site.selectExpr(
        *SITE, "CASE WHEN size(codes) > 0 THEN array_join(codes, ', ') END AS site_codes",
        f"left({found}, length({found}) - 2) AS po_usage")


def site_codes(site_tag: DataFrame, tag_type: DataFrame) -> DataFrame:
    return (site_tag_texts(site_tag, tag_type).select(*SITE, "site_codes")
            .where("site_codes IS NOT NULL"))


def po_usage(site_tag: DataFrame, tag_type: DataFrame) -> DataFrame:
    return (site_tag_texts(site_tag, tag_type).select(*SITE, "po_usage")
            .where("po_usage IS NOT NULL"))
