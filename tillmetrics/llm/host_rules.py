"""Quality rules judged by host: shrunken failure rates decide how strict a host is read.

Every text is measured with built-in functions. Each rule has a strict and a lenient
limit. A host's share of texts beyond the strict limit is shrunk toward the share of all
hosts by a beta prior that is fitted to the hosts' rates (by their mean and variance), so
a host of few texts is not judged by chance. Where the shrunken rate is high the strict
limit holds for the host's texts, elsewhere the lenient one. A text thus falls by
what it is itself; its host only decides which limit applies.

Failures are counted per host before the shuffle, one short row per host and task,
whatever share of all rows a host has. Verdicts are joined to the measures without texts;
Spark may split a large host over several tasks of that join.

Defined results: a null text has no words. Texts with a null host form a host of their
own. Without hosts the prior is flat. Repeated rows are each judged and counted. Other
columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.llm.tables import stored

BLANKS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]+"
BAD_HOST = 0.3  # shrunken rate above which a host is read strictly
PRIOR_WEIGHT = (1.0, 1000.0)  # texts that the prior stands for, at least and at most


@dataclass(frozen=True)
class Limit:
    """A rule's name and the SQL of being beyond its strict and its lenient limit."""

    name: str
    strict: str
    lenient: str


LIMITS = (
    Limit("symbols", "10 * n_symbols > n_words", "3 * n_symbols > n_words"),
    Limit("lines", "100 * n_dup_lines > 15 * n_lines", "100 * n_dup_lines > 30 * n_lines"),
    Limit("repeats", "100 * n_repeat_words > 35 * n_words", "100 * n_repeat_words > 50 * n_words"),
    Limit("letters", "word_chars > 14 * n_words", "word_chars > 20 * n_words"),
)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the array."""
    last = F.greatest(F.size(words) - 2, F.lit(0))
    hashes = F.transform(
        F.slice(words, F.lit(1), last), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    )

    def covered(found: Column) -> Column:
        places = F.array_sort(F.transform(found, lambda x: x["i"]))
        begin = F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n"))
        return F.aggregate(
            places,
            begin,
            lambda acc, p: F.struct(p.alias("at"), (acc["n"] + F.least(F.lit(3), p - acc["at"])).alias("n")),
            lambda acc: acc["n"],
        )

    def beside(s: Column, k: Column) -> Column:
        return F.get(s, k)["h"]

    def count(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        repeated = _let(
            ordered,
            lambda s: covered(
                F.filter(s, lambda x, k: x["h"].eqNullSafe(beside(s, k - 1)) | x["h"].eqNullSafe(beside(s, k + 1)))
            ),
        )
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated)

    return _let(hashes, count)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The key, the host and the measures of each text."""
    rows = docs.select(F.col(key).alias("key"), F.col(host).alias("host"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumns(
        {
            "words": F.filter(F.split("text", BLANKS), lambda w: w != ""),
            "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)),
        }
    )
    return rows.select(
        "key",
        "host",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("bigint").alias("n_repeat_words"),
    ).withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def host_failures(measures: DataFrame) -> DataFrame:
    """Per host the number of texts and of those beyond each rule's strict limit."""
    failures = [F.count_if(F.expr(r.strict)).alias(r.name) for r in LIMITS]
    return measures.groupBy("host").agg(F.count("*").alias("texts"), *failures)


def priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Per rule the beta prior that hosts' rates suggest, as its mean and its weight in texts."""
    parts = []
    for r in LIMITS:
        rate = F.col(r.name) / F.col("texts")
        parts += [F.avg(rate).alias(f"mean_{r.name}"), F.var_pop(rate).alias(f"spread_{r.name}")]
    row = hosts.agg(*parts).first()  # one row, whatever the number of hosts
    out = {}
    for r in LIMITS:
        mean, spread = row[f"mean_{r.name}"], row[f"spread_{r.name}"]
        if mean is None:
            out[r.name] = (0.5, 2.0)
            continue
        weight = mean * (1 - mean) / spread - 1 if spread else PRIOR_WEIGHT[1]
        out[r.name] = (mean, min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1]))
    return out


def verdicts(hosts: DataFrame) -> DataFrame:
    """Per host and rule the shrunken rate, and whether the host is read strictly."""
    columns = []
    for name, (mean, weight) in priors(hosts).items():
        rate = (F.col(name) + mean * weight) / (F.col("texts") + weight)
        columns += [rate.alias(f"rate_{name}"), (rate > BAD_HOST).alias(f"strict_{name}")]
    return hosts.select("host", "texts", *columns)


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The key, host and measures of each text, base_failed, and whether it is kept."""
    measures = stored(measured(docs, key, text, host), "measures")
    hosts = stored(verdicts(host_failures(measures)), "hosts").withColumnRenamed("host", "of_host")
    fails = F.lit(False)
    for r in LIMITS:
        fails = fails | F.when(F.col(f"strict_{r.name}"), F.expr(r.strict)).otherwise(F.expr(r.lenient))
    joined = measures.join(hosts, F.col("host").eqNullSafe(F.col("of_host")), "left")
    return joined.select(
        F.col("key").alias(key),
        *[F.col(c) for c in measures.columns if c != "key"],
        (~F.col("base_failed") & ~F.coalesce(fails, F.lit(False))).alias("kept"),
    )
