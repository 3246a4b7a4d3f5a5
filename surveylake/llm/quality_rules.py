"""Quality rules: measures of each text, and lines that many documents of a host share."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm.common import free_names, table, written

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """A text of fewer words, or with more of them in repeated windows (percent), fails. A line in more than
    `line_pct` percent of the texts of its host, and in more than `line_documents` of them, is removed; a document
    that loses more than `removed_pct` percent of its words that way is rejected. The share makes a host judged alike
    at every size; the number only keeps a line of a few texts of a small host. The measures are those of the text as
    given."""

    words: int = 50
    repeat_pct: int = 50
    line_pct: int = 1
    line_documents: int = 20
    removed_pct: int = 80


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda word: word != "")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.array_join(_words(line), " ")))


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per row: key, host, a hash of the text, the base measures, and (hash, words) of each line with a word.

    A null text has no words. Windows of three words are told apart by 64-bit hashes; sorting them with their places
    puts the repeated ones side by side, and is left out where no hash repeats.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.col(host), F.lit("")).alias("host"),
        F.xxhash64(raw).alias("text_hash"),
        _words(raw).alias("words"),
        F.length(F.regexp_replace(raw, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split(raw, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    windows = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    counted = split.select(
        "doc_id",
        "host",
        "text_hash",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(
            "lines",
            lambda line: F.struct(
                _line_hash(line).alias("line"),
                F.size(_words(line)).cast("long").alias("words"),
            ),
        ).alias("lines"),
        F.slice(windows, 1, F.greatest(F.size("words") - 2, F.lit(0))).alias("windows"),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    ordered = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    counted = counted.withColumn("windows", F.when(repeats, ordered))
    beside = lambda w, i: (F.get("windows", i - 1)["w"] == w["w"]) | (F.get("windows", i + 1)["w"] == w["w"])
    places = F.sort_array(F.transform(F.filter("windows", lambda w, i: F.coalesce(beside(w, i), F.lit(False))), lambda w: w["i"]))
    counted = counted.withColumn("windows", places)
    covered = F.transform("windows", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("windows", i + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda done, n: done + n)
    return counted.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("windows")


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """`doc_id`, `host`, `text_hash`, the measures, `base_failed`, `removed_words`, `kept` of every row."""
    return _judged(docs, limits, key, text, host).drop("cut")


def _judged(docs: DataFrame, limits: Limits, key: str, text: str, host: str) -> DataFrame:
    """The judged rows with `cut`, the hashes of a row's frequent lines (null: none).

    Every text is read once: its measures and line hashes go to a table in the shared folder. Documents are counted per
    host in distinct texts: with documents themselves, every line of a clean text that has many copies would be
    frequent, and the copy that de-duplication keeps would be lost here. A null host is the empty one. Rows are told
    apart by key, host and text, so repeated rows and null keys are judged alike and all returned. A hot line or host is
    counted in part by each task, and only lines above the number meet the sizes of their hosts; the frequent lines are
    a table of their own, so that a join that does not broadcast them can split a hot line. A very long text is one row
    of its task, with 8 bytes a window of words; an empty one has no lines and fails.
    """
    profile = written(measures(docs, key, text, host), "profile")
    lines = profile.select("doc_id", "host", "text_hash", F.inline("lines"))
    seen = lines.groupBy("host", "line").agg(F.count_distinct("text_hash").alias("documents"))
    hosts = profile.groupBy("host").agg(F.count_distinct("text_hash").alias("texts"))
    common = seen.where(F.col("documents") > limits.line_documents).join(hosts, "host")
    frequent = common.where(100 * F.col("documents") > limits.line_pct * F.col("texts")).select("host", "line")
    frequent = written(frequent, "frequent-lines")
    removed = lines.join(frequent, ["host", "line"]).groupBy("doc_id", "host", "text_hash")
    removed = removed.agg(F.sum("words").alias("lost"), F.collect_set("line").alias("cut"))
    copies = profile.groupBy("doc_id", "host", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    one = removed.join(copies, _same(removed, copies, ["doc_id", "host", "text_hash"])).select(
        removed["doc_id"].alias("_doc"), removed["host"].alias("_host"), removed["text_hash"].alias("_text"),
        F.floor(F.col("lost") / F.col("rows")).alias("_lost"), "cut",
    )
    same = (F.col("doc_id").eqNullSafe(F.col("_doc"))) & (F.col("host") == F.col("_host")) & (F.col("text_hash") == F.col("_text"))
    base = (F.col("n_words") < limits.words) | (100 * F.col("n_repeat_words") > limits.repeat_pct * F.col("n_words"))
    depleted = 100 * F.col("removed_words") > limits.removed_pct * F.col("n_words")
    found = profile.drop("lines").join(one, same, "left").withColumn("removed_words", F.coalesce("_lost", F.lit(0)))
    return found.drop("_doc", "_host", "_text", "_lost").select("*", base.alias("base_failed"), (~base & ~depleted).alias("kept"))


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(and_, [left[n].eqNullSafe(right[n]) for n in names])


def passing(
    docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text", host: str = "source", chars: str = "n_chars"
) -> DataFrame:
    """The rows that `judged` keeps, with all their columns and without the frequent lines of their host.

    Other lines stay as they are, in their order, and a text without frequent lines is not touched. A column `chars`
    gets the length of each shortened text. Rejected and shortened rows are a written table of one row for each key,
    host and text, which carries no text; one join does both, by one plan at every size, and moves each text once.
    """
    names = ["doc_id", "host", "text_hash"]
    work = _judged(docs, limits, key, text, host).where("not kept or cut is not null").select(*names, "kept", "cut")
    id_, home, hashed, kept, cut = free_names(docs, "_doc_id", "_host", "_text_hash", "_kept", "_cut")
    work = written(work.dropDuplicates(names).toDF(id_, home, hashed, kept, cut), "rejected-or-shortened")
    raw = F.coalesce(F.col(text), F.lit(""))
    same = F.col(key).eqNullSafe(F.col(id_)) & (F.coalesce(F.col(host), F.lit("")) == F.col(home))
    left = docs.join(work.hint("merge"), same & (F.xxhash64(raw) == F.col(hashed)), "left").where(F.coalesce(F.col(kept), F.lit(True)))
    rest = F.array_join(F.filter(F.split(raw, "\n"), lambda line: ~F.array_contains(cut, _line_hash(line))), "\n")
    new = {text: rest} | ({chars: F.length(rest).cast(docs.schema[chars].dataType)} if chars in docs.columns else {})
    changed = lambda n: F.when(F.col(cut).isNull(), F.col(n)).otherwise(new[n]).alias(n)
    return left.select(*[changed(n) if n in new else F.col(n) for n in docs.columns])


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select("doc_id", *MEASURES, "base_failed", "kept", "removed_words")


def sql(source: str = "documents", limits: Limits = Limits()) -> str:
    """The same for DuckDB: every row of `source` with its measures and verdict."""
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, *, coalesce(text, '') AS raw, coalesce(source, '') AS host FROM {source}),
split AS MATERIALIZED (
  SELECT r, host, raw, regexp_extract_all(raw, '{word}') AS words,
         list_filter(string_split(raw, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts),
windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(generate_series(1, len(words) - 2)) AS i FROM split)),
places AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next_i
  FROM (SELECT *, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT r, sum(least(3, coalesce(next_i - i, 3))) AS n FROM places GROUP BY r),
lines AS (
  SELECT r, host, raw, array_to_string(ws, ' ').lower() AS line, len(ws) AS words
  FROM (SELECT r, host, raw, regexp_extract_all(unnest(lines), '{word}') AS ws FROM split)),
hosts AS (SELECT host, count(DISTINCT raw) AS texts FROM texts GROUP BY host),
frequent AS (
  SELECT host, line FROM lines JOIN hosts USING (host) GROUP BY host, line, texts
  HAVING count(DISTINCT raw) > {limits.line_documents} AND 100 * count(DISTINCT raw) > {limits.line_pct} * texts),
removed AS (SELECT r, sum(words) AS lost FROM lines JOIN frequent USING (host, line) GROUP BY r),
measured AS (
  SELECT t.*, len(s.words)::BIGINT AS n_words, length(array_to_string(s.words, ''))::BIGINT AS word_chars,
         length(regexp_replace(s.raw, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
         (len(s.lines) - len(list_distinct(s.lines)))::BIGINT AS n_dup_lines,
         coalesce(p.n, 0)::BIGINT AS n_repeat_words, coalesce(m.lost, 0)::BIGINT AS removed_words
  FROM texts t JOIN split s USING (r) LEFT JOIN repeats p USING (r) LEFT JOIN removed m USING (r))
SELECT * EXCLUDE (r, raw, host),
       n_words < {limits.words} OR 100 * n_repeat_words > {limits.repeat_pct} * n_words AS base_failed,
       NOT (n_words < {limits.words} OR 100 * n_repeat_words > {limits.repeat_pct} * n_words
            OR 100 * removed_words > {limits.removed_pct} * n_words) AS kept
FROM measured"""


OP1_SQL = f"SELECT doc_id, {', '.join(MEASURES)}, base_failed, kept, removed_words FROM ({sql()})"
