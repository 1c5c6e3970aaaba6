"""Secret scans: a trigram index names candidates per rule, regular expressions verify them.

All of it is DataFrame expressions, joins and windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession, Window

from sparkgate.llm import trigrams
from sparkgate.llm.tables import BROADCAST_BYTES, narrow_enough, stage


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches whose group has fewer than least characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, then those this operator adds.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login_url", r"[a-z]+://[^\x20/:@]+:[^\x20/:@]+@[A-Za-z0-9.-]+"),
)
RULES = BASE_RULES + MORE_RULES


def trigram_postings(texts: DataFrame, wanted: list[str]) -> DataFrame:
    """The inverted index of the wanted trigrams: trigram, doc_id, h. Texts in lower case."""
    low = F.lower("text")
    present = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in wanted]))
    return texts.select("doc_id", "h", F.explode(present).alias("trigram"))


def candidates(spark: SparkSession, postings: DataFrame, rules: dict[int, str]) -> DataFrame:
    """doc_id, h, rule: texts that hold all trigrams of one of the rule's alternatives."""
    rows = [
        (rule, branch, trigram, len(needed))
        for rule, pattern in rules.items()
        for branch, needed in enumerate(trigrams.branches(pattern))
        for trigram in sorted(needed)
    ]
    asked = spark.createDataFrame(rows, "rule int, branch int, trigram string, needed int")
    return (
        postings.join(F.broadcast(asked), "trigram")
        .groupBy("doc_id", "h", "rule", "branch", "needed")
        .agg(F.count_distinct("trigram").alias("found"))
        .filter("found = needed")
        .select("doc_id", "h", "rule")
        .distinct()
    )


def _spans(texts: DataFrame, number: int, rule: Rule) -> DataFrame:
    """doc_id, h, rule, start, stop of the rule's matches, in code points.

    The text is split at the matches; the lengths of parts and matches add up to places.
    """
    pattern = F.lit(rule.pattern)
    length = lambda parts: F.transform(parts, lambda part: F.length(part))
    zipped = F.arrays_zip(
        length(F.split("text", rule.pattern, -1)).alias("before"),
        length(F.regexp_extract_all("text", pattern, 0)).alias("size"),
        length(F.regexp_extract_all("text", pattern, rule.group)).alias("value"),
    )
    matches = (
        texts.filter(F.rlike("text", pattern))
        .select("doc_id", "h", F.posexplode(zipped).alias("n", "m"))
        .select("doc_id", "h", "n", "m.*")
        .filter("size IS NOT NULL")
    )
    so_far = Window.partitionBy("doc_id", "h").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    # Repeated rows repeat a match; one of each counts.
    return (
        matches.distinct()
        .withColumn("stop", F.sum(F.col("before") + F.col("size")).over(so_far))
        .filter(F.col("value") >= rule.least)
        .select("doc_id", "h", F.lit(number).alias("rule"), (F.col("stop") - F.col("size")).alias("start"), "stop")
    )


def find_secrets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, h, rule (number), start, stop: all matches of all rules in all texts.

    h is the text's hash; with doc_id it names a text. Rules with mandatory trigrams look only at
    the texts the index names for them; the others look at all texts.
    """
    texts = _texts(documents, id_col, text_col)
    queried = {n: rule.pattern for n, rule in enumerate(rules) if trigrams.branches(rule.pattern)}
    wanted = sorted({t for p in queried.values() for b in trigrams.branches(p) for t in b})
    found = [_spans(texts, n, rule) for n, rule in enumerate(rules) if n not in queried]
    if queried:
        postings = trigram_postings(texts, wanted)
        named = stage(candidates(documents.sparkSession, postings, queried), "candidates")
        for n in queried:
            own = named.filter(F.col("rule") == n).select(
                F.col("doc_id").alias("own_id"), F.col("h").alias("own_h")
            )
            looked_at = texts.join(
                narrow_enough(own, 48),
                F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h")),
                "left_semi",
            )
            found.append(_spans(looked_at, n, rules[n]))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _texts(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return documents.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).withColumn("h", F.xxhash64("text"))


def scanned(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    base_sha256 is of the base rules' spans, kind:start:end by start, then kind as listed,
    comma-joined; spans holds those of all rules. A text without a match has counts of 0 and empty
    spans, as have null and empty texts. Ids may be null or repeat. Other columns are not read.
    """
    spans = stage(find_secrets(documents, id_col, text_col, rules=rules), "spans")
    listed = _listed(spans)
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    n_base = len(BASE_RULES)

    def joined(found: Column) -> Column:
        text = F.transform(
            found, lambda s: F.concat_ws(":", F.element_at(kinds, s["rule"] + 1), s["start"], s["stop"])
        )
        return F.concat_ws(",", text)

    found = F.coalesce("found", F.expr("CAST(array() AS ARRAY<STRUCT<start: BIGINT, rule: INT, stop: BIGINT>>)"))
    rows = _texts(documents, id_col, text_col).select("doc_id", "h")
    named = listed.select(F.col("doc_id").alias("own_id"), F.col("h").alias("own_h"), "found")
    whole = rows.join(
        named, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h")), "left"
    ).select("doc_id", found.alias("found"))
    count = lambda n: F.size(F.filter("found", lambda s: s["rule"] == n)).cast("long")
    return whole.select(
        "doc_id",
        *[count(n).alias(f"n_{rule.kind}") for n, rule in enumerate(rules[:n_base])],
        F.sha2(joined(F.filter("found", lambda s: s["rule"] < n_base)), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def _listed(spans: DataFrame) -> DataFrame:
    """Each text's spans in one sorted array, found."""
    ordered = F.sort_array(F.collect_list(F.struct("start", "rule", "stop")))
    return spans.groupBy("doc_id", "h").agg(ordered.alias("found"))


def redacted(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars",
    *, rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """documents with every span of every rule replaced by its kind in brackets.

    Spans that overlap are replaced as one, under the kind of the first. length_col, if there is
    one, becomes the length of a text that changed. All other rows and columns stay as they are.
    """
    spans = stage(find_secrets(documents, id_col, text_col, rules=rules), "spans")
    listed = _listed(spans)
    if spans.count() * 64 <= BROADCAST_BYTES:
        listed = F.broadcast(listed)
    # Rows travel whole, so that no name of theirs can clash with one used here.
    rows = documents.select(F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("row"))
    text = F.col("row").getField(text_col)
    whole = F.coalesce(text.cast("string"), F.lit(""))
    marks = F.array(*[F.lit(f"[{rule.kind}]") for rule in rules])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        size = F.greatest(span["start"] - done["at"], F.lit(0)).cast("int")
        between = F.substring(whole, (done["at"] + 1).cast("int"), size)
        mark = F.when(span["start"] >= done["at"], F.element_at(marks, span["rule"] + 1)).otherwise("")
        return F.struct(
            F.greatest(done["at"], span["stop"]).alias("at"), F.concat(done["out"], between, mark).alias("out")
        )

    clean = F.aggregate(
        "found", start, step,
        lambda done: F.concat(done["out"], F.substring(whole, (done["at"] + 1).cast("int"), F.length(whole))),
    )
    hit = F.col("found").isNotNull()
    joined = rows.join(
        listed, F.col("row").getField(id_col).eqNullSafe(F.col("doc_id")) & (F.xxhash64(whole) == F.col("h")), "left"
    ).withColumn("clean", F.when(hit, clean).otherwise(text))

    def column(name: str) -> Column:
        value = F.col("row").getField(name)
        if name == text_col:
            value = F.col("clean")
        elif name == length_col:
            value = F.when(hit, F.length("clean").cast(documents.schema[name].dataType)).otherwise(value)
        return value.alias(name)

    return joined.select(*[column(name) for name in documents.columns])


def _oracle_sql() -> str:
    parts = []
    for n, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, {n} AS rule, unnest(string_split_regex(text, '{pattern}')) AS before,
      unnest(regexp_extract_all(text, '{pattern}', 0)) AS hit,
      unnest(regexp_extract_all(text, '{pattern}', {rule.group})) AS value,
      generate_subscripts(string_split_regex(text, '{pattern}'), 1) AS n, {rule.least} AS least
    FROM d WHERE regexp_matches(text, '{pattern}')"""
        )
    kinds = ", ".join(f"'{rule.kind}'" for rule in RULES)
    union = "\n    UNION ALL ".join(parts)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
    {union}
), s AS (
  SELECT *, sum(length(before) + length(hit)) OVER (PARTITION BY doc_id, rule ORDER BY n) AS stop
  FROM m WHERE hit IS NOT NULL
), k AS (
  SELECT doc_id, rule, ([{kinds}])[rule + 1] || ':' || (stop - length(hit))::BIGINT || ':' || stop::BIGINT AS span,
    (stop - length(hit))::BIGINT AS start
  FROM s WHERE length(value) >= least
), a AS (
  SELECT doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access,
    count(*) FILTER (rule = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, rule) FILTER (rule < {len(BASE_RULES)}) AS base,
    string_agg(span, ',' ORDER BY start, rule) AS spans
  FROM k GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


ORACLE_SQL = _oracle_sql()
