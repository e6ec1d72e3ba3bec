"""Line-first cleaning: lines are judged one by one, then the document by what it lost.

Every line goes through punctuation, navigation, boilerplate, stutter and repetition rules.
Failing lines are removed; a document that loses too much of its text is rejected. Before
that, two base rules hold for whole texts: enough words, and not too many words in eight-word
windows that occur twice.

There are two sets of line rules. The default one is that of op10's SQL: any line with a phrase
of BOILERPLATE fails, and blank lines and later copies of a line go and count as lost. With
`notices_only`, as the pipeline cleans, a line fails as boilerplate only if it is a notice or
mostly made of such phrases, closing brackets are text, and all lines that fail no rule stay as
they are, blank and equal ones included.

Defined results: a null or empty text has no words, fails the base rules and is rejected. Rows
are judged one by one, so repeated rows get equal results and other columns play no part. A
table without rows gives none. Everything is an expression over one row; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.common import let, text_of, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Phrases that mark a line as boilerplate, whatever surrounds them. Lower case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use",
    "terms of service", "privacy policy", "cookie", "javascript", "lorem ipsum", "copyright",
    "subscribe to", "sign up for", "click here", "read more", "share this",
)
BOILERPLATE_PATTERN = "|".join(BOILERPLATE)
# Notices, as whole lines or phrases that prose on the same topics does not have. Lower case.
NOTICE_PATTERN = "|".join((
    r"^\W*(?:copyright\s*(?:©|\(c\)|[0-9]{4})|©|\(c\)\s*[0-9]{4})",
    r"(?:^|[.;,|)0-9-]\s*)all rights reserved\W*$",
    r"^\W*(?:this (?:work|software|project|program|page|site|website|document|content|file|"
    r"article|text|code|material) is )?(?:licensed|released) under the\b",
    r"\b(?:we|site|website|page) uses? cookies\b", r"\baccept (?:all )?cookies\b",
    r"^\W*(?:please )?enable javascript\b", r"\bjavascript (?:is disabled|must be enabled)\b",
    r"^\W*(?:please )?(?:subscribe to|sign up for) (?:our|my)\b.*\b(?:newsletter|updates|list|feed|channel)\b",
))
# Phrases that make a line a notice if they are at least half of it.
PHRASE_PATTERN = (
    r"\b(?:all rights reserved|terms of use|terms of service|privacy policy|cookie policy|"
    r"cookie settings|cookie notice|lorem ipsum|click here|read more|share this)\b"
)
BRACKETS = r"^[\s{}()\[\];,]+$"
MENU_SEPARATORS = "|»›•·"
HAS_WORD = r"[^\x20\x09-\x0D]"
HAS_LETTER_OR_DIGIT = r"[\p{L}\p{N}]"


@dataclass(frozen=True)
class QualityRules:
    """Thresholds. Shares are percentages, so that all comparisons are between integers."""

    min_words: int = 20
    max_repeat_pct: int = 30
    # Of a line's characters other than white space, at most this many may be symbols.
    max_symbol_pct: int = 10
    # Separators of a menu: at least so many, and one for at most so many characters.
    min_menu_separators: int = 3
    menu_chars_per_separator: int = 40
    # Exclamation marks: at least so many, and one for at most so many characters.
    min_exclamations: int = 4
    chars_per_exclamation: int = 20
    # Boilerplate phrases count in lines of at most so many characters.
    max_boilerplate_chars: int = 200
    # Lines of at least so many words stutter if few are different and many repeat the one before.
    stutter_words: int = 10
    stutter_distinct_pct: int = 25
    stutter_adjacent_pct: int = 50
    # Only notices are boilerplate; lines that fail no rule stay as they are.
    notices_only: bool = False
    # A document must keep this share of its characters other than white space.
    min_kept_pct: int = 50


def _count(text: Column, chars: str) -> Column:
    """Occurrences of any of the characters. Most texts have none, which a search tells faster."""
    held = F.length(text) - F.length(F.translate(text, chars, ""))
    return F.when(text.rlike("[" + chars + "]"), held).otherwise(0)


def _ink(tokens: Column) -> Column:
    """Characters other than white space."""
    return F.length(F.array_join(tokens, ""))


# ---------------------------------------------------------------- repeated windows


def _tail(array: Column, skip: int) -> Column:
    return F.slice(array, skip + 1, F.greatest(F.size(array) - skip, F.lit(0)))


def _window_hashes(tokens: Column) -> Column:
    """A 64-bit hash for each eight-word window."""
    starts = F.slice(tokens, 1, F.greatest(F.size(tokens) - (WINDOW - 1), F.lit(0)))
    return F.transform(starts, lambda _, i: F.xxhash64(F.slice(tokens, i + 1, WINDOW)))


def _repeated_positions(pairs: Column) -> Column:
    """Positions `p` of those pairs (k, p) whose `k` occurs more than once."""
    return let(
        F.sort_array(pairs),
        lambda s: F.array_distinct(
            F.flatten(
                F.zip_with(
                    F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))),
                    _tail(s, 1),
                    lambda a, b: F.when(a["k"] == b["k"], F.array(a["p"], b["p"])).otherwise(
                        F.array().cast("array<int>")
                    ),
                )
            )
        ),
    )


def _covered(positions: Column) -> Column:
    """Words inside at least one of the windows that start at these positions."""
    return let(
        F.sort_array(positions),
        lambda s: F.aggregate(
            F.zip_with(
                s, _tail(s, 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))
            ),
            F.lit(0),
            lambda total, x: total + x,
        ),
    )


def repeat_words(tokens: Column) -> Column:
    """Words in eight-word windows found at least twice in the text, first ones included.

    `tokens` should be an argument of a lambda (see `let`), as it is named many times.

    Hashes only tell which windows may be repeated; those are compared as text, so that equal
    hashes of different windows change nothing.
    """

    def exact(tokens: Column, hashes: Column) -> Column:
        candidates = _repeated_positions(
            F.transform(hashes, lambda h, i: F.struct(h.alias("k"), i.alias("p")))
        )
        confirmed = _repeated_positions(
            F.transform(
                candidates,
                lambda p: F.struct(
                    F.array_join(F.slice(tokens, p + 1, WINDOW), " ").alias("k"), p.alias("p")
                ),
            )
        )
        return _covered(confirmed)

    return F.when(
        F.size(tokens) > WINDOW,
        let(
            _window_hashes(tokens),
            lambda h: F.when(
                F.size(F.array_distinct(h)) < F.size(h), exact(tokens, h)
            ).otherwise(0),
        ),
    ).otherwise(0)


# ---------------------------------------------------------------- lines


def _adjacent(tokens: Column) -> Column:
    """Words that equal the one before."""
    return F.size(F.filter(F.zip_with(tokens, _tail(tokens, 1), lambda a, b: a == b), lambda x: x))


def _boilerplate(line: Column, ink: Column, rules: QualityRules) -> Column:
    lowered = F.lower(line)
    if not rules.notices_only:
        return lowered.rlike(BOILERPLATE_PATTERN)
    rest = _ink(words(F.regexp_replace(lowered, PHRASE_PATTERN, " ")))
    return lowered.rlike(NOTICE_PATTERN) | (lowered.rlike(PHRASE_PATTERN) & (rest * 2 <= ink))


def failing_rule(line: Column, rules: QualityRules) -> Column:
    """The first rule that a line fails, or null. Lines without a word fail none."""

    def judge(tokens: Column, ink: Column) -> Column:
        separators = _count(line, MENU_SEPARATORS)
        exclamations = _count(line, "!")
        bare = ~line.rlike(HAS_LETTER_OR_DIGIT)
        if rules.notices_only:
            bare = bare & ~line.rlike(BRACKETS)
        return (
            F.when(ink == 0, F.lit(None).cast("string"))
            .when(
                (separators >= rules.min_menu_separators)
                & (separators * rules.menu_chars_per_separator >= ink),
                "navigation",
            )
            .when(_count(line, SYMBOLS) * 100 > ink * rules.max_symbol_pct, "punctuation")
            .when(
                (exclamations >= rules.min_exclamations)
                & (exclamations * rules.chars_per_exclamation >= ink),
                "punctuation",
            )
            .when(bare, "punctuation")
            .when(
                (ink <= rules.max_boilerplate_chars)
                & _boilerplate(line, ink, rules),
                "boilerplate",
            )
            .when(
                (F.size(tokens) >= rules.stutter_words)
                & (
                    F.size(F.array_distinct(tokens)) * 100
                    <= F.size(tokens) * rules.stutter_distinct_pct
                )
                & (_adjacent(tokens) * 100 >= F.size(tokens) * rules.stutter_adjacent_pct),
                "stutter",
            )
        )

    return let(words(line), lambda t: let(_ink(t), lambda ink: judge(t, ink)))


def clean_lines(
    docs: DataFrame, text: str = "text", rules: QualityRules = QualityRules(), prefix: str = "q_"
) -> DataFrame:
    """All columns of `docs`, and what the rules find, in columns that start with `prefix`.

    `clean_text` is the text without its failing lines and, unless `notices_only` is set, without
    blank lines and later copies of a line; `clean_chars` counts its characters other than white space. Columns of `docs` that
    already have one of these names are replaced.
    """
    body = text_of(text)
    lines = F.split(body, "\n")
    with_word = F.filter(lines, lambda line: line.rlike(HAS_WORD))
    good = F.filter(
        lines if rules.notices_only else with_word, lambda line: failing_rule(line, rules).isNull()
    )
    if not rules.notices_only:
        good = F.array_distinct(good)
    counted = let(
        words(body),
        lambda t: F.struct(
            F.size(t).cast("long").alias("n_words"),
            _ink(t).cast("long").alias("word_chars"),
            repeat_words(t).cast("long").alias("n_repeat_words"),
        ),
    )
    out = docs.withColumns(
        {
            f"{prefix}counted": counted,
            f"{prefix}n_symbols": _count(body, SYMBOLS).cast("long"),
            f"{prefix}n_dup_lines": let(
                with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))
            ).cast("long"),
            f"{prefix}clean_text": F.array_join(good, "\n"),
        }
    )
    out = out.withColumns(
        {
            f"{prefix}{c}": F.col(f"{prefix}counted.{c}")
            for c in ("n_words", "word_chars", "n_repeat_words")
        }
    ).drop(f"{prefix}counted")
    n_words, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    out = out.withColumns(
        {
            f"{prefix}base_failed": (n_words < rules.min_words)
            | (repeats * 100 > n_words * rules.max_repeat_pct),
            f"{prefix}clean_chars": _ink(words(F.col(f"{prefix}clean_text"))).cast("long"),
        }
    )
    lost_little = (
        F.col(f"{prefix}clean_chars") * 100 >= F.col(f"{prefix}word_chars") * rules.min_kept_pct
    )
    return out.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & lost_little)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: the base counts, the verdicts, and how much text the lines keep."""
    judged = clean_lines(docs.select("doc_id", "text"))
    return judged.select(
        "doc_id",
        *[F.col(f"q_{c}").alias(c) for c in COUNTS],
        F.col("q_base_failed").alias("base_failed"),
        F.col("q_kept").alias("kept"),
        F.col("q_clean_chars").alias("clean_chars"),
    )
