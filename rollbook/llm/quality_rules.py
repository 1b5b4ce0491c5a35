"""Quality rules with host-level verdicts.

Each text is measured once. A host (`source`) is then judged by the share of its documents that break a
rule, shrunk towards a beta prior that is fitted to all hosts, so that a host with few documents isn't
judged by chance. A document goes if it fails the base rules, or breaks a rule that its host breaks
habitually: clean documents of a bad host stay.

Cases: a null or blank text has no words and fails; a null host is a host of its own; repeated rows are
judged row by row and count once each; an empty table gives an empty result; columns of the input other
than those asked for with `carry` are not looked at, and may not be named like a result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.scratch import keep

#: ASCII white space, as in the words of the measures.
BLANKS = r"[\\x20\\x09-\\x0D]"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """Production thresholds."""

    min_words: int = 20
    repeat_pct: int = 30
    #: Rules that count only at a host that breaks them habitually.
    symbol_pct: int = 8
    dup_line_pct: int = 25
    soft_repeat_pct: int = 15
    max_word_chars: int = 15
    #: A host is bad at a rule if its shrunk failure rate exceeds this.
    host_rate: float = 0.4

    def failures(self) -> dict[str, str]:
        return {
            "words": f"n_words < {self.min_words}",
            "repeats": f"100 * n_repeat_words > {self.soft_repeat_pct} * n_words",
            "symbols": f"100 * n_symbols > {self.symbol_pct} * word_chars",
            "lines": f"100 * n_dup_lines > {self.dup_line_pct} * n_lines",
            "long_words": f"word_chars > {self.max_word_chars} * n_words",
        }

    def base(self) -> str:
        return f"n_words < {self.min_words} OR 100 * n_repeat_words > {self.repeat_pct} * n_words"


def measure(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """The carried columns and the measures of the column `text`; row by row, nothing is shuffled."""
    window = ", ".join(f"get(_hashes, i + {k})" for k in range(WINDOW))
    if clash := {*carry} & {*MEASURES, "base_failed", "host_failed", "kept"}:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    # kept apart, so that no name can clash
    step = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("_own"), F.expr("coalesce(text, '')").alias("_text"))
    step = step.withColumn("_words", F.expr(f"array_remove(split(_text, '{BLANKS}+'), '')"))
    step = step.withColumns(
        {
            "_hashes": F.expr("transform(_words, w -> xxhash64(w))"),
            "_joined": F.expr("array_join(_words, '')"),
            "_lines": F.expr(r"filter(split(_text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"),
        }
    )
    step = step.withColumn(
        "_windows",
        F.expr(f"if(size(_hashes) < {WINDOW}, array(), transform(sequence(0, size(_hashes) - {WINDOW}), i -> xxhash64({window})))"),
    )
    # only texts in which some window comes twice pay for the sort
    step = step.withColumn(
        "_sorted",
        F.expr("if(size(array_distinct(_windows)) < size(_windows), sort_array(transform(_windows, (h, i) -> struct(h, i))), array())"),
    )
    step = step.withColumn(
        "_found",
        F.expr("sort_array(transform(filter(_sorted, (s, j) -> s.h <=> get(_sorted, j - 1).h OR s.h <=> get(_sorted, j + 1).h), s -> s.i))"),
    )
    covered = F.expr(
        f"aggregate(transform(_found, (p, j) -> least({WINDOW}, coalesce(get(_found, j + 1) - p, {WINDOW}))), 0L, (a, x) -> a + x)"
    )
    return step.select(
        "_own.*",
        F.expr("CAST(size(_words) AS BIGINT)").alias("n_words"),
        F.expr("CAST(length(_joined) AS BIGINT)").alias("word_chars"),
        F.expr("CAST(length(_joined) - length(regexp_replace(_joined, '[#*$%&|<>]+', '')) AS BIGINT)").alias("n_symbols"),
        F.expr("CAST(size(_lines) AS BIGINT)").alias("n_lines"),
        F.expr("CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT)").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def beta_prior(hosts: DataFrame, failed: list[str]) -> dict[str, tuple[float, float]]:
    """Beta parameters of each rule by the moments of the hosts' failure rates, each host weighed by its documents.

    The weight of the prior lies between 2 and 1000 documents. One row of sums comes to the driver.
    """
    sums = [F.sum("n_docs").alias("n")]
    for r in failed:
        sums += [F.sum(r).alias(f"s_{r}"), F.sum(F.expr(f"CAST({r} AS DOUBLE) * {r} / n_docs")).alias(f"q_{r}")]
    row = hosts.agg(*sums).first()
    prior = {}
    for r in failed:
        n = row["n"] or 0
        mean = row[f"s_{r}"] / n if n else 0.0
        spread = row[f"q_{r}"] / n - mean * mean if n else 0.0
        weight = min(1000.0, max(2.0, mean * (1 - mean) / spread - 1)) if spread > 0 else 1000.0
        prior[r] = (mean * weight, (1 - mean) * weight)
    return prior


def host_verdicts(measured: DataFrame, rules: Rules, host: str = "source") -> DataFrame:
    """One row per host: documents, and for each rule its shrunk failure rate and whether that is too high."""
    failed = {f"f_{name}": rule for name, rule in rules.failures().items()}
    hosts = keep(
        measured.groupBy(F.col(host).alias("_host")).agg(
            F.count(F.lit(1)).alias("n_docs"),
            *(F.sum(F.expr(f"CAST({rule} AS BIGINT)")).alias(name) for name, rule in failed.items()),
        ),
        "hosts",
    )
    prior = beta_prior(hosts, list(failed))
    rates = {f"rate_{r[2:]}": (F.col(r) + F.lit(a)) / (F.col("n_docs") + F.lit(a + b)) for r, (a, b) in prior.items()}
    hosts = hosts.withColumns(rates)
    return hosts.withColumns({f"bad_{r[5:]}": F.col(r) > F.lit(rules.host_rate) for r in rates})


def quality_rules(docs: DataFrame, rules: Rules = Rules(), carry: tuple[str, ...] = ("doc_id", "source"), host: str = "source") -> DataFrame:
    """One row per row of `docs`: carried columns, measures, base_failed, host_failed and kept."""
    measured = keep(measure(docs, tuple(dict.fromkeys((*carry, host)))), "measures")
    hosts = host_verdicts(measured, rules, host)
    bad = [f"bad_{name}" for name in rules.failures()]
    both = measured.join(hosts.select("_host", *bad), F.col(host).eqNullSafe(F.col("_host")), "left")
    host_failed = F.expr(" OR ".join(f"(bad_{name} AND ({rule}))" for name, rule in rules.failures().items()))
    return both.select(
        *carry,
        *MEASURES,
        F.expr(rules.base()).alias("base_failed"),
        host_failed.alias("host_failed"),
    ).withColumn("kept", F.expr("NOT base_failed AND NOT host_failed"))
