"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a built-in expression over the words of the whole text, and
every rule a comparison of one measure with a bound; no user function, join or
shuffle is involved.

Defined results: a null text has no words, like an empty one, and fails the
base rule. Repeated rows and ties each get their own row. Ratios over nothing
are 0. Stop words are judged only in texts of which at least half the letters are
Latin, the script of all lists; a text without letters is judged. Other columns are kept; an input column named like a measure is replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import let, space_words

WINDOW = 5
#: Words to a stop word up to which a text counts as written in a listed language.
FEW = 10
SYMBOLS = "[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"

#: Frequent function words of the languages served.
STOP_WORDS = {
    "en": "a an and are as at be but by for from has have he in is it of on or that the this to was were will with you",
    "fr": "au aux avec ce dans de des du elle en est et il la le les ne ou par pas pour que qui sur un une",
    "de": "als am auch auf aus bei das dem den der des die ein eine es für ich im in ist mit nicht sich sie und von zu",
    "es": "al como con de del el en es esta la las lo los más no para pero por que se su un una y",
    "it": "che di il la per non una con del sono",
    "pt": "que de não uma para com os do da em",
    "nl": "het een van en de dat niet op te zijn",
    "sv": "och att det som en är på för av inte",
    "da": "og at det som en er på for af ikke",
    "pl": "nie na się do to że jest jak od po",
    "cs": "se na že je to ve jako za by pro",
    "ro": "de la și în cu nu pe care din este",
    "fi": "ja on ei että se oli hän mutta kuin myös",
    "tr": "bir ve bu da de için ile çok gibi olarak",
}


class Rule(NamedTuple):
    """A document passes if ``low <= measure <= high``.

    Texts below ``from_words`` words are not judged, nor, if ``latin_only``, those mostly in other letters.
    """

    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0
    latin_only: bool = False


RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", high=0.3),
    Rule("stop_word_ratio", low=0.02, from_words=50, latin_only=True),
    Rule("dup_line_ratio", high=0.5),
    Rule("bullet_line_ratio", high=0.9),
    Rule("ellipsis_line_ratio", high=0.5),
)


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that occur at least twice in the text.

    Texts without a repeated window need one hash set; only the others are
    sorted. Cost is n log n for any length.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(p: Column) -> Column:
            same = lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"])
            starts = F.sort_array(F.transform(F.filter(p, same), lambda x: x["i"]))
            zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            step = lambda a, i: F.struct((a["n"] + i + width - F.greatest(a["end"], i)).alias("n"), (i + width).alias("end"))
            return F.aggregate(starts, zero, step)["n"]

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, repeats))

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)])
    )
    return F.when(F.size(words) < width, F.lit(0)).otherwise(let(hashes, covered))


def mostly_latin(text: Column) -> Column:
    """Whether at least half of the letters are Latin."""
    kept = lambda signs: F.length(F.regexp_replace(text, f"[^{signs}]+", ""))
    return 2 * kept(r"\p{IsLatin}") >= kept(r"\p{L}")


def measures(text: Column, stop_words: dict[str, str] = STOP_WORDS) -> Column:
    """All counts of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    stops = sorted({w for words in stop_words.values() for w in words.split()})

    def counts(w: Column, lines: Column, n_stops: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            n_stops.cast("long").alias("n_stop_words"),
            # Letters are counted only where few words are stop words.
            ((n_stops * FEW >= F.size(w)) | mostly_latin(text)).alias("latin"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).cast("long").alias("n_bullet_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long").alias("n_ellipsis_lines"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD))
    n_stops = lambda w: F.size(F.filter(w, lambda x: F.lower(x).isin(stops)))
    return let(space_words(text), lambda w: let(lines, lambda ls: let(n_stops(w), lambda n: counts(w, ls, n))))


def ratios(m: Column) -> dict[str, Column]:
    over = lambda a, b: F.when(m[b] == 0, F.lit(0.0)).otherwise(m[a] / m[b])
    return {
        "mean_word_chars": over("word_chars", "n_words"),
        "symbols_per_word": over("n_symbols", "n_words"),
        "stop_word_ratio": over("n_stop_words", "n_words"),
        "dup_line_ratio": over("n_dup_lines", "n_lines"),
        "bullet_line_ratio": over("n_bullet_lines", "n_lines"),
        "ellipsis_line_ratio": over("n_ellipsis_lines", "n_lines"),
    }


def compiled(rules: tuple[Rule, ...], m: Column) -> Column:
    """Names of the rules that a document breaks, in the table's order."""
    values, broken = ratios(m), []
    for rule in rules:
        value, tests = values[rule.measure], []
        if rule.low is not None:
            tests.append(value < rule.low)
        if rule.high is not None:
            tests.append(value > rule.high)
        bad = tests[0] if len(tests) == 1 else tests[0] | tests[1]
        if rule.latin_only:
            bad = bad & m["latin"]
        broken.append(F.when((m["n_words"] >= rule.from_words) & bad, F.lit(rule.measure)))
    return F.array_compact(F.array(*broken))


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The input's columns but the text's, the counts, the broken rules, and ``kept``."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    new = {*counts, "base_failed", "kept", "broken_rules"}
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text and c not in new]
    measured = docs.select(*rest, measures(F.col(f"`{text}`")).alias("__m"))
    m = F.col("__m")
    base = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    judged = measured.select(*rest, *[m[c].alias(c) for c in counts], base.alias("base_failed"), compiled(rules, m).alias("broken_rules"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
