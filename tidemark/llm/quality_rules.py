"""Quality rules: a threshold table compiled into column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, words_of

#: Fixed values of the contract: base limits and the characters that count as symbols.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"

#: Frequent function words of the languages the rules know, also as they begin a sentence.
STOP_WORDS = (
    "the of and to in a is that for on with as was at by it this are be from "
    "der die das und ist von den mit ein zu auf für im nicht "
    "de la el que en los las un una por con no es y se del "
    "le les des et est une du qui dans pour pas sur au il "
    "di che per non della sono os uma não para het een van niet"
).split()
STOP_WORDS = sorted({*STOP_WORDS, *(word.capitalize() for word in STOP_WORDS)})

GAP = r"[ \t\n\x0B\f\r]"
LATIN = "[A-Za-zÀ-ÖØ-öø-ɏ]"  # the script of the stop words
LONG_WORD = 1000  # characters of a word that is no prose


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie in [low, high]; an open side is None. A metric that is null has no say."""

    metric: str
    low: float | None = None
    high: float | None = None


#: A document is kept if every metric is inside its limits. A ratio without a denominator is 0; that of
#: stop words is null where less than half of the words with letters have one of LATIN.
RULES = (
    Rule("mean_word_length", 1.5, 20.0),
    Rule("long_word_ratio", None, 0.5),
    Rule("symbol_word_ratio", None, 0.5),
    Rule("letter_word_ratio", 0.5, None),
    Rule("stop_word_ratio", 0.02, None),
    Rule("duplicate_line_ratio", None, 0.3),
    Rule("ellipsis_line_ratio", None, 0.5),
    Rule("bullet_line_ratio", None, 0.95),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _three(words: Column, i: Column) -> list[Column]:
    return [F.get(words, i + k) for k in range(3)]


def _covered(starts: Column) -> Column:
    """Words covered by three-word windows that begin at the ascending ``starts``."""
    return F.aggregate(
        starts,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and ratios of every row, beside ``row``, a struct of all its columns.

    Repeated windows: equal windows have equal hashes, so a text whose hashes are all distinct has
    none. Otherwise (hash, words, position) are sorted and neighbours compared by their words.
    """
    words, windows = F.col("words"), F.col("windows")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = docs.select(
        F.struct(*[docs[name] for name in docs.columns]).alias("row"),
        docs[id_col].cast("long").alias("doc_id"),
        words_of(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")).alias("lines"),
    )
    places = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(places, lambda i: F.xxhash64(*_three(words, i)))
    base = base.withColumns(
        {
            "compact": F.array_join(words, ""),
            "hashes": F.when(F.size(words) >= 4, hashes),
        }
    )

    def window(i: Column) -> Column:
        a, b, c = _three(words, i)
        return F.struct(F.xxhash64(a, b, c).alias("h"), a.alias("a"), b.alias("b"), c.alias("c"), i.alias("i"))

    base = base.withColumn(
        "windows",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.sort_array(F.transform(places, window)),
        ),
    )

    def same(x: Column, j: Column) -> Column:
        y = F.get(windows, j)
        return F.coalesce(
            (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False)
        )

    starts = F.sort_array(
        F.array_compact(
            F.transform(windows, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
        )
    )
    n_words = F.size(words).cast("long")
    n_lines, compact = F.size("lines"), F.col("compact")
    counted = base.select(
        "row",
        "doc_id",
        n_words.alias("n_words"),
        F.length(compact).cast("long").alias("word_chars"),
        F.regexp_count(compact, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(starts), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).alias("letter_words"),
        F.size(F.filter(words, lambda w: w.rlike(LATIN))).alias("latin_words"),
        F.size(F.filter(words, lambda w: w.isin(STOP_WORDS))).cast("long").alias("stop_words"),
        F.coalesce(F.length(F.array_join(F.filter(words, lambda w: F.length(w) > LONG_WORD), "")), F.lit(0)).alias("long_chars"),
        F.size(F.filter("lines", lambda x: x.rlike(rf"(\.\.\.|…){GAP}*\z"))).alias("ellipsis_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(rf"^{GAP}*[-*•·–]{GAP}"))).alias("bullet_lines"),
        n_lines.alias("n_lines"),
    )
    return counted.select(
        *["row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        "stop_words",
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_length"),
        _ratio(F.col("n_symbols"), F.col("n_words")).alias("symbol_word_ratio"),
        _ratio(F.col("long_chars"), F.col("word_chars")).alias("long_word_ratio"),
        _ratio(F.col("letter_words"), F.col("n_words")).alias("letter_word_ratio"),
        F.when(2 * F.col("latin_words") >= F.col("letter_words"), _ratio(F.col("stop_words"), F.col("n_words"))).alias(
            "stop_word_ratio"
        ),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("duplicate_line_ratio"),
        _ratio(F.col("ellipsis_lines"), F.col("n_lines")).alias("ellipsis_line_ratio"),
        _ratio(F.col("bullet_lines"), F.col("n_lines")).alias("bullet_line_ratio"),
    )


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one boolean expression over the columns of measure()."""
    verdict = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            verdict = verdict & F.coalesce(F.col(rule.metric) >= rule.low, F.lit(True))
        if rule.high is not None:
            verdict = verdict & F.coalesce(F.col(rule.metric) <= rule.high, F.lit(True))
    return verdict


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    failed = base_failed()
    return measure(docs, id_col, text_col).withColumns(
        {"base_failed": failed, "kept": ~failed & compile_rules(rules)}
    )


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts, ratios, base_failed and kept.

    A null or empty text has no words and fails the base rules. A null doc_id stays null. Repeated
    rows are judged one by one; an empty table gives no rows. A very long text is judged whole, in the
    memory of one task. Columns other than the two are ignored. Nothing is shuffled.
    """
    return judge(docs, id_col, text_col).drop("row")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    A row number holds the filter above the projections: pushed below them it would evaluate the
    word arrays anew in each of its terms.
    """
    judged = judge(docs, id_col, text_col).withColumn("number", F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("number") >= 0)).select("row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def _verdict_sql() -> str:
    sides = []
    for rule in RULES:
        if rule.low is not None:
            sides.append(f"coalesce({rule.metric} >= {rule.low}, TRUE)")
        if rule.high is not None:
            sides.append(f"coalesce({rule.metric} <= {rule.high}, TRUE)")
    return " AND ".join(sides)


def judged_sql(source: str) -> str:
    """SQL for quality_rules() over the relation ``source``, whose doc_id is unique."""
    stop = ", ".join(f"'{word}'" for word in STOP_WORDS)
    return f"""
    WITH base AS (
      SELECT doc_id, coalesce(text, '') AS t FROM {source}
    ), split AS (
      SELECT doc_id, t,
             list_filter(regexp_split_to_array(t, '{GAP}+'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS lines
      FROM base
    ), word AS (
      SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM split
    ), triple AS (
      SELECT doc_id, i, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c
      FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ), start AS (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM triple WHERE c IS NOT NULL
    ), covered AS (
      SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
      FROM start, unnest([0, 1, 2]) AS u(k) WHERE n > 1 GROUP BY doc_id
    ), counted AS (
      SELECT doc_id, len(words) AS n_words,
             length(list_aggregate(words, 'string_agg', '')) AS chars,
             len(regexp_extract_all(t, '{SYMBOLS}')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             len(list_filter(words, lambda x: regexp_matches(x, '\\p{{L}}'))) AS letter_words,
             len(list_filter(words, lambda x: regexp_matches(x, '{LATIN}'))) AS latin_words,
             len(list_filter(words, lambda x: x IN ({stop})))::BIGINT AS stop_words,
             coalesce(list_sum(list_transform(list_filter(words, lambda x: length(x) > {LONG_WORD}), lambda x: length(x))), 0) AS long_chars,
             len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…){GAP}*\\z'))) AS ellipsis_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '^{GAP}*[-*•·–]{GAP}'))) AS bullet_lines,
             len(lines) AS n_lines
      FROM split
    ), ratios AS (
      SELECT doc_id, n_words::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
             n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             stop_words,
             CASE WHEN n_words > 0 THEN chars / n_words::DOUBLE ELSE 0 END AS mean_word_length,
             CASE WHEN n_words > 0 THEN n_symbols / n_words::DOUBLE ELSE 0 END AS symbol_word_ratio,
             CASE WHEN chars > 0 THEN long_chars / chars::DOUBLE ELSE 0 END AS long_word_ratio,
             CASE WHEN n_words > 0 THEN letter_words / n_words::DOUBLE ELSE 0 END AS letter_word_ratio,
             CASE WHEN 2 * latin_words >= letter_words
                  THEN CASE WHEN n_words > 0 THEN stop_words / n_words::DOUBLE ELSE 0 END END AS stop_word_ratio,
             CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines::DOUBLE ELSE 0 END AS duplicate_line_ratio,
             CASE WHEN n_lines > 0 THEN ellipsis_lines / n_lines::DOUBLE ELSE 0 END AS ellipsis_line_ratio,
             CASE WHEN n_lines > 0 THEN bullet_lines / n_lines::DOUBLE ELSE 0 END AS bullet_line_ratio
      FROM counted LEFT JOIN covered USING (doc_id)
    ), failed AS (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
      FROM ratios
    )
    SELECT *, NOT base_failed AND {_verdict_sql()} AS kept FROM failed
    """


OP3_SQL = judged_sql("documents")
