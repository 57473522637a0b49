"""Quality rules, line first, in DataFrame functions only.

Each line is tested on its own: punctuation (short lines that don't end a
sentence, words that end in runs of marks), navigation (words between bars)
and boilerplate (stock phrases). Lines that fail are removed, and a document
that loses too much of its text is rejected. Document-wide counts (length,
repeats) come beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import WORD

#: Stock phrases of web pages in several languages, tested without regard to case.
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved", "enable javascript", "click here", "login to", "log in to",
    "sign up for", "sign up to", "subscribe to", "lorem ipsum", "skip to content", "powered by",
    "alle rechte vorbehalten", "datenschutzerklärung", "cookie-richtlinie", "zum inhalt springen", "tous droits réservés", "politique de confidentialité", "mentions légales",
    "aller au contenu", "todos los derechos reservados", "política de privacidad", "aviso legal", "saltar al contenido", "tutti i diritti riservati", "todos os direitos reservados",
)
#: Ends a sentence in Latin, Greek, Arabic, Indic, Armenian, Ethiopic and East Asian scripts, with closing quotes or brackets after it.
SENTENCE_END = r"[.!?:;…。！？：；．｡؟۔।॥։።][\"'»”’)\]」』）】]*$"
#: Last characters of a line, but for white space, in which that is looked for.
END_CHARS = 8
#: Letters of scripts that write words without spaces between them.
UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}]"
SYMBOL = r"[#*$%&|<>]"
#: A run of marks that prose doesn't end a word with.
MARKS = r"[#*$%&<>]{2,}|[!?]{2,}"
BAR = r"\|"

#: A line with fewer words that doesn't end a sentence fails, unless it has so many letters of a script without spaces.
SHORT_LINE = 3
SHORT_UNSPACED = 8
#: Shares of a line's words: runs of marks, bars.
MOST_MARKS = 0.3
MOST_BARS = 0.2
#: A document is rejected if less of its characters are left.
LEAST_LEFT = 0.5
#: Document rules: fewer words, or a larger percentage of words in repeated windows, fail.
LEAST_WORDS = 10
MOST_REPEATED = 20
GRAM = 5


def has_stock_phrase(lower: Column) -> Column:
    """One plain pattern each, which is searched for in long steps; an alternation would be tried at every character."""
    found = F.lit(False)
    for phrase in BOILERPLATE:
        found = found | lower.rlike(phrase)
    return found


def line_fails(line: Column, stock: Column) -> Column:
    """Whether a line with at least one word fails a line rule; ``stock``: its text has a stock phrase somewhere."""
    # what most lines pass comes first, as words are counted anew for each use
    words = F.regexp_count(line, F.lit(WORD))
    end = F.right(F.rtrim(line, F.lit(" \t\r\x0b\x0c")), F.lit(END_CHARS))
    unfinished = ~end.rlike(SENTENCE_END) & (words < SHORT_LINE) & (F.regexp_count(line, F.lit(UNSPACED)) < SHORT_UNSPACED)
    marks = line.rlike(MARKS) & (F.regexp_count(line, F.lit(MARKS)) > words * MOST_MARKS)
    bars = line.contains("|") & (F.regexp_count(line, F.lit(BAR)) > words * MOST_BARS)
    return unfinished | marks | bars | (stock & has_stock_phrase(F.lower(line)))


def _repeated(hashes: Column) -> Column:
    """Words in windows whose hash comes twice or more: mark such windows' places, then add up what each covers anew."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def marked(p: Column) -> Column:
        def place(x: Column, i: Column) -> Column:
            twin = (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"])
            return F.when(F.coalesce(twin, F.lit(False)), x["i"])

        return F.sort_array(F.filter(F.transform(p, place), lambda i: i.isNotNull()))

    start = F.struct(F.lit(0).alias("n"), F.lit(-GRAM).alias("last"))
    step = lambda a, i: F.struct((a["n"] + F.least(F.lit(GRAM), i - a["last"])).alias("n"), i.alias("last"))
    # transform over one-element arrays binds the sorted pairs once
    places = F.element_at(F.transform(F.array(pairs), marked), 1)
    return F.aggregate(places, start, step, lambda a: a["n"])


def assess(docs: DataFrame) -> DataFrame:
    """Rows with a text column, plus a struct ``quality``.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, kept, cleaned (the text without failed lines; unchanged if no
    line fails), left (share of characters left). Null and empty texts have no
    words and fail; other columns, whatever their names, are kept untouched;
    equal rows are judged each; an empty table gives no rows. Rows are judged
    alone, so nothing is shuffled.
    """
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select("row", "text", F.lower("text").alias("lower"))
    rows = rows.select("row", "text", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"), has_stock_phrase(F.col("lower")).alias("stock"))
    # of a window, word by word: slices of the array would be copied for each
    window = lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(GRAM)])
    hashes = F.when(F.size("words") < GRAM, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - GRAM, F.lit(0))), window))
    rows = rows.select("row", "text", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "lines", F.filter("lines", lambda x: ~line_fails(x, F.col("stock"))).alias("good"), hashes.alias("hashes"))
    repeated = F.when(F.size(F.array_distinct("hashes")) == F.size("hashes"), F.lit(0)).otherwise(_repeated(F.col("hashes"))).cast("long")
    chars = lambda c: F.length(F.array_join(c, ""))
    rows = rows.select(
        "row", "text", "n_words", "word_chars",
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        F.when(F.size("good") == F.size("lines"), F.col("text")).otherwise(F.array_join("good", "\n")).alias("cleaned"),
        F.coalesce(F.try_divide(chars("good").cast("double"), chars("lines").cast("double")), F.lit(0.0)).alias("left"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    rows = rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("left") >= LEAST_LEFT))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "cleaned", "left"]
    return rows.select("row", F.struct(*fields).alias("quality"))


def keep(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, lang, source, n_chars) that pass, with failed lines removed from their texts.

    n_chars follows a changed text. Null and empty texts go; equal rows are
    judged alike and kept each; other columns, whatever their names, are kept as
    they are; an empty table gives no rows.
    """
    # not deterministic in the optimiser's eyes, so that the filter isn't pushed down, which would evaluate all rules again
    verdict = F.col("quality.kept") & (F.monotonically_increasing_id() >= 0)
    judged = assess(docs).withColumn("verdict", verdict).filter("verdict")
    changed = F.col("quality.cleaned")
    out = [changed.alias("text") if c == "text" else F.when(changed == F.col("row.text"), F.col("row.n_chars")).otherwise(F.length(changed)).cast(t).alias(c) if c == "n_chars" else F.col(f"row.`{c}`") for c, t in docs.dtypes]
    return judged.select(*out)
