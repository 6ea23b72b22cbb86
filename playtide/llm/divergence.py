"""Quality rules by distribution divergence: character classes and common words against references of the language.

Everything is a column expression. Word windows, lines and histograms are worked out within the row, so a document never meets a
shuffle; only its few counts are written, and the references are means of those counts per language.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import SPACE, table
from playtide.session import written

# Frequent function words of the supported languages.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "was", "with", "on", "as", "are", "this", "from"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con"],
}
# Character classes, each a regular expression for one character; what none matches is class "other".
CLASSES = {
    "lower": r"\p{Ll}", "upper": r"\p{Lu}", "digit": r"\p{Nd}", "space": SPACE, "stop": r"[.,;:!?'\x22()-]",
    "symbol": r"[#*$%&|<>@^~=+/\\_{}\[\]`]",
}
WINDOW = 5
#: Least characters for the class histogram and words for the word histogram of a document to say something.
MIN_CHARS, MIN_WORDS = 200, 100
#: Documents of such length and without a failed base rule that make a reference.
MIN_DOCS = 10


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"(?:{pattern})+", ""))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _covered(starts: Column, n: int) -> Column:
    """Words covered by windows of ``n`` words at these ascending starts."""
    return F.coalesce(
        F.aggregate(
            starts, F.struct(F.lit(-n).alias("last"), F.lit(0).alias("words")),
            lambda a, s: F.struct(s.alias("last"), (a["words"] + F.least(s - a["last"], F.lit(n))).alias("words")),
            lambda a: a["words"]),
        F.lit(0))


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """Words inside ``n``-word windows that the text holds at least twice, the first occurrence included.

    Windows are compared by 64-bit hashes. Most texts repeat none: those sort plain longs only; the others also sort the
    places, so equal windows meet next to each other.
    """
    def with_hashes(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = lambda s: F.array_sort(F.transform(
            F.filter(
                F.transform(s, lambda x, k: F.struct(
                    x["i"].alias("i"),
                    (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
                lambda x: x["twice"]),
            lambda x: x["i"]))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _covered(_let(ordered, starts), n))

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(F.size(words) < n + 1, F.lit(0)).otherwise(_let(hashes, with_hashes)).cast("long")


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: counts, class histogram (array by CLASSES and other) and common-word histogram by language."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", f"{SPACE}+"), ""))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    listed = sorted({w for words in COMMON_WORDS.values() for w in words})
    hits = F.filter(F.transform("words", F.lower), lambda w: w.isin(listed))
    length = F.length("text")
    counts = [(length - _without(F.col("text"), p)).cast("long") for p in CLASSES.values()]
    rows = rows.select(
        "doc_id", "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", f"{SPACE}+", "")).cast("long").alias("word_chars"),
        (F.octet_length("text") - F.octet_length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        length.cast("long").alias("length"), F.array(*counts).alias("classes"),
        _let(hits, lambda h: F.struct(*(
            F.transform(F.array(*map(F.lit, words)), lambda w: F.size(F.filter(h, lambda x: x == w))).alias(name)
            for name, words in COMMON_WORDS.items()
        ))).alias("common"),
    )
    return rows


def _shares(counts: Column, total: Column) -> Column:
    """The counts and the rest of the total, as shares; an empty total gives zeros."""
    rest = F.greatest(total - F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    return F.transform(
        F.concat(F.transform(counts, lambda x: x.cast("long")), F.array(rest)),
        lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def _divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms of shares."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    both = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.aggregate(both, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def references(measured: DataFrame, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Mean histograms of each supported language over its documents that are long enough and pass the base rules.

    Each such document weighs the same, so no long one sets the reference. A histogram of fewer than ``min_docs`` documents is null.
    """
    names = list(CLASSES) + ["other"]
    sound = measured.filter(F.col("lang").isin(list(COMMON_WORDS))).filter(~base_failed())
    shares = sound.select(
        "lang", F.when(F.col("length") >= min_chars, _shares(F.col("classes"), F.col("length"))).alias("c"),
        F.when(F.col("n_words") >= min_words, reduce(
            lambda a, name: F.when(F.col("lang") == name, _shares(F.col("common")[name], F.col("n_words"))).otherwise(a),
            COMMON_WORDS, F.lit(None).cast("array<double>"))).alias("w"))
    size = max(map(len, COMMON_WORDS.values())) + 1
    means = shares.groupBy("lang").agg(
        F.count("c").alias("c"), F.count("w").alias("w"),
        *(F.avg(F.col("c")[i]).alias(f"c{i}") for i in range(len(names))),
        *(F.avg(F.col("w")[i]).alias(f"w{i}") for i in range(size)))
    return means.select(
        "lang", F.when(F.col("c") >= min_docs, F.array(*(f"c{i}" for i in range(len(names))))).alias("ref_classes"),
        F.when(F.col("w") >= min_docs, F.array(*(f"w{i}" for i in range(size)))).alias("ref_common"))


def base_failed() -> Column:
    """Whether a measured document is too short or repeats itself."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    max_class_distance: float = 0.18, max_word_distance: float = 0.24, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Measure every document and compare it with the references of its language.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept.
    Character classes count against documents of at least ``min_chars`` characters, common words against those of at least
    ``min_words`` words; a shorter histogram says nothing. A document without a supported language (null or other) is held
    against the nearest reference. A language with fewer than ``min_docs`` documents to learn from has no reference: its classes are held
    against the nearest one of another language, its words against none. Null text counts as empty; an empty text fails the base rules. Repeated rows are judged each;
    other columns are not read. Without any reference (an empty table) no distance exists and only the base rules count.
    """
    measured = written(features(docs, doc_id, text, lang), "divergence")
    means = references(measured, min_chars, min_words, min_docs)
    # One row for each supported language, so bounded by COMMON_WORDS: they become constants of the expression.
    found = {r["lang"]: r for r in means.collect()}
    zero = F.lit(None).cast("double")

    def distance(column: str, of, lent: bool) -> Column:
        each = {
            name: _divergence(of(name), F.array(*(F.lit(float(x)) for x in found[name][column]))) for name in COMMON_WORDS
            if name in found and found[name][column] is not None
        }
        if not each:
            return zero
        nearest = F.least(*each.values()) if len(each) > 1 else next(iter(each.values()))
        own = {name: each.get(name, nearest if lent else zero) for name in COMMON_WORDS}
        return reduce(lambda a, name: F.when(F.col("lang") == name, own[name]).otherwise(a), own, nearest)

    judged = measured.withColumns({
        "class_distance": distance("ref_classes", lambda _: _shares(F.col("classes"), F.col("length")), lent=True),
        "word_distance": distance("ref_common", lambda name: _shares(F.col("common")[name], F.col("n_words")), lent=False),
    })
    strange = ((F.col("length") >= min_chars) & (F.col("class_distance") > max_class_distance)) | (
        (F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        "class_distance", "word_distance", (~base_failed() & ~F.coalesce(strange, F.lit(False))).alias("kept"))


def op4_quality_rules(spark, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"))
