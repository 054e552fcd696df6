"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` is the whole configuration: a name, a metric (a SQL expression over
the measures below), and the bounds in which a good document lies.
``quality_rules`` turns it into columns; no user function takes part.

Defined cases: a null text counts as empty; an empty text has zero measures
and fails the base rule.  A metric whose divisor is zero is null, and a null
metric breaks no rule.  Rows are judged one by one, so repeated rows repeat.
Other columns of the input pass through only if named in ``keep_columns``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Common function words of the languages with a stop-word rule.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "was", "for", "on", "with", "be", "by", "this", "from", "or", "at", "are", "as", "an", "he"],
    "de": ["der", "die", "das", "und", "in", "zu", "den", "von", "ist", "mit", "des", "im", "dem", "nicht", "ein", "eine", "auf", "sich", "als", "auch", "für"],
    "fr": ["le", "la", "les", "de", "des", "du", "et", "un", "une", "en", "est", "dans", "que", "qui", "pour", "au", "sur", "avec", "par", "ce"],
    "es": ["el", "la", "los", "las", "de", "del", "y", "un", "una", "en", "es", "que", "para", "por", "con", "se", "su", "al", "no", "lo"],
}

#: name, metric, least and most value of a good document (None: no bound).
RULES: list[tuple[str, str, float | None, float | None]] = [
    ("word_length", "word_chars / n_words", 2.0, 20.0),
    ("symbols", "n_symbols / n_words", None, 0.3),
    ("duplicate_lines", "n_dup_lines / n_lines", None, 0.5),
    ("ellipsis_lines", "n_ellipsis_lines / n_lines", None, 0.5),
    ("echoes", "n_echo_words / n_words", None, 0.3),
    ("letters", "n_letters / word_chars", 0.5, None),
    ("capitals", "n_capitals / n_letters", None, 0.5),
    ("stop_words", "n_stop_words", 2, None),
]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, n_words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more in the document."""
    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def positions(s: Column) -> Column:
        same = F.transform(s, lambda x, j: F.when((F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["p"]))
        return F.sort_array(F.filter(same, lambda p: p.isNotNull()))

    def from_hashes(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, j: F.struct(h.alias("h"), j.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _let(pairs, lambda s: _let(positions(s), covered)))

    windows = _let(F.transform(words, lambda w: F.xxhash64(w)), lambda codes: F.transform(
        F.sequence(F.lit(1), F.size(codes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(codes, i, WINDOW))))
    return F.when(n_words > WINDOW, _let(windows, from_hashes)).otherwise(F.lit(0))


def measures(docs: DataFrame, text: str = "text", lang: str = "lang", keep_columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Counts of every document that the rules divide."""
    has_lang = lang in docs.columns
    base = docs.select(*keep_columns, F.coalesce(F.col(text), F.lit("")).alias("_text"),
                       (F.col(lang) if has_lang else F.lit(None).cast("string")).alias("_lang"))
    step = base.withColumns({
        "_words": F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)),
        "_lines": F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD)),
    })
    count = lambda pattern: F.length("_text") - F.length(F.regexp_replace("_text", pattern, ""))
    stops = F.lit(None).cast("int")
    for code, words in STOP_WORDS.items():
        both = F.array(*[F.lit(x) for w in words for x in dict.fromkeys([w, w.capitalize()])])
        stops = F.when(F.col("_lang") == code, F.size(F.array_intersect("_words", both))).otherwise(stops)
    return step.select(
        *keep_columns,
        F.size("_words").cast("long").alias("n_words"),
        count(r"[^\x20\x09-\x0D]").cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words"), F.size("_words")).cast("long").alias("n_repeat_words"),
        _let(F.col("_words"), lambda ws: F.size(F.filter(ws, lambda w, i: w == F.get(ws, i - 1)))).cast("long").alias("n_echo_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_lines", lambda x: F.rtrim(x).endswith("..."))).cast("long").alias("n_ellipsis_lines"),
        count(r"\p{L}").cast("long").alias("n_letters"),
        count(r"\p{Lu}").cast("long").alias("n_capitals"),
        stops.cast("long").alias("n_stop_words"),
    )


def verdicts(measured: DataFrame, rules=RULES) -> DataFrame:
    """Adds base_failed, the names of broken rules and kept."""
    broken = []
    for name, metric, least, most in rules:
        value = F.expr(metric)
        bad = F.lit(False)
        if least is not None:
            bad = bad | (value < F.lit(least))
        if most is not None:
            bad = bad | (value > F.lit(most))
        broken.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)))
    base = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    out = measured.withColumns({"base_failed": base, "broken_rules": F.array_compact(F.array(*broken))})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", keep_columns: Sequence[str] = ("doc_id",), rules=RULES) -> DataFrame:
    """Measures and verdict of every document."""
    # division by zero is null here, whatever spark.sql.ansi.enabled says
    safe = [(n, " / ".join([m.split(" / ")[0], f"nullif({m.split(' / ')[1]}, 0)"]) if " / " in m else m, a, b) for n, m, a, b in rules]
    return verdicts(measures(docs, text, lang, keep_columns), safe)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns unchanged."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      F.col(f"`{text}`").alias("_t"), (F.col(f"`{lang}`") if lang in docs.columns else F.lit(None).cast("string")).alias("_l"))
    judged = quality_rules(row, "_t", "_l", ("_row",), rules)
    # a filter on kept would be pushed below the measures, which are then worked out once for every rule that uses them
    return judged.select(F.explode_outer(F.when(F.col("kept"), F.array("_row"))).alias("_good")).where("_good is not null").select("_good.*")
