"""Quality rules: divergence from language references.

Base rules count words, symbols, repeated lines and repeated three-word windows of the
whole text. The method compares two histograms of a document with a reference of its
language, by Jensen-Shannon distance (square root of the divergence in bits, 0 to 1):

- character classes (lower case, capitals, digits, white space, sentence marks, other
  ASCII marks, beyond ASCII), against the language's own;
- common words: the language's function words below plus "any other word".

References are sums over all documents of the same ``lang`` value that pass the base
rules, so they follow the corpus; no language is compared with another's. Guards: a histogram is only compared when the document has
``min_chars`` characters or ``min_words`` words, and when its language has at least
``min_reference`` documents behind its reference; otherwise that distance is null and
does not speak against the document.

Defined cases: a null or blank text has no words and fails the base rules; a language
without function words below is compared by character classes alone; a null or blank
language has no reference, so the base rules alone judge it;
repeated rows are judged each on its own; an empty table gives an empty result; other
columns of the input are kept by ``judge`` unless they clash with a result column, in
which case the result column replaces them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, Scratch, slices, texts

# Function words of the listed languages.
COMMON_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "was", "with", "be", "as", "by",
           "are", "this", "at", "from"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "qui", "dans",
           "a", "par", "plus", "pas", "au"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im",
           "dem", "nicht", "ein", "eine", "als"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una",
           "su", "para", "es", "lo"),
}
SYMBOLS = b"#*$%&|<>"
# Character classes by first byte of a code point; continuation bytes are not counted.
CLASSES = ("lower", "upper", "digit", "white", "sentence", "mark", "wide")

MIN_CHARS, MIN_WORDS, MIN_REFERENCE = 100, 50, 20
# A distance from a sample of n words is inflated by about 1/sqrt(n): a document may
# differ by the first number plus the second over sqrt(n_words).
CLASS_LIMIT, WORD_LIMIT = (0.15, 0.9), (0.15, 1.6)


def _class_table() -> np.ndarray:
    out = np.full(256, CLASSES.index("mark"), np.int64)
    out[ord("a"):ord("z") + 1] = CLASSES.index("lower")
    out[ord("A"):ord("Z") + 1] = CLASSES.index("upper")
    out[ord("0"):ord("9") + 1] = CLASSES.index("digit")
    out[list(WHITE)] = CLASSES.index("white")
    out[list(b".,;:!?'\"()-")] = CLASSES.index("sentence")
    out[0xC0:] = CLASSES.index("wide")
    out[0x80:0xC0] = len(CLASSES)  # continuation bytes
    return out


_CLASS = _class_table()
_COMMON = {lang: {w.encode(): i for i, w in enumerate(ws)} for lang, ws in COMMON_WORDS.items()}


def repeated_words(words: list) -> int:
    """Words covered by three-word windows that occur at least twice in the text."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: set = set()
    twice: set = set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if w in twice:
            covered += i + 3 - max(end, i)
            end = i + 3
    return covered


def measure(text: str, lang: str | None) -> tuple:
    """The base counts and both histograms of one text."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    white = len(raw) - len(raw.translate(None, WHITE))
    seen: set[bytes] = set()
    dup_lines = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(WHITE):
            seen.add(line)
    classes = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 1)[:len(CLASSES)]
    common = _COMMON.get(lang or "")
    hist: list[int] = []
    if common:
        hist = [0] * (len(common) + 1)
        for w in words:
            hist[common.get(w, -1)] += 1
    return (len(words), len(text) - white, len(raw) - len(raw.translate(None, SYMBOLS)), dup_lines,
            repeated_words(words), classes.tolist(), hist)


_MEASURED = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "class_hist array<long>, word_hist array<long>, ref_lang string")
RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance",
          "word_distance", "base_failed", "kept")
RESERVED = {*RESULT, "class_hist", "word_hist", "ref_lang", "_text", "_lang"}


def measured(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns of each row with its counts and histograms; one pass over the text."""
    return counted(docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_text"), F.col("lang").alias("_lang")), carry)


def counted(rows: DataFrame, carry: list[str]) -> DataFrame:
    """``measured`` rows (_text, _lang and more), of which ``carry`` may name those two as well."""
    names = [f.strip().split(" ")[0] for f in _MEASURED.split(", ")]
    schema = rows.select(*[F.col(f"`{c}`") for c in carry]).schema
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), _MEASURED])

    def run(batches):
        for batch in slices(batches):
            langs = batch.column("_lang").to_pylist()
            found = [measure(t, lg) for t, lg in zip(texts(batch.column("_text")), langs)]
            cols = [list(c) for c in zip(*found)] if found else [[] for _ in names[:-1]]
            cols.append([lg if lg and lg.strip() else None for lg in langs])
            types = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2 + [pa.string()]
            arrays = [batch.column(c) for c in carry] + [pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*carry, *names])

    return rows.mapInArrow(run, ddl)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def references(m: DataFrame) -> DataFrame:
    """Per language: summed histograms of the documents that pass the base rules."""
    good = m.where(~base_failed() & F.col("ref_lang").isNotNull())
    width = max(len(v) for v in COMMON_WORDS.values()) + 1
    sums = [F.sum(F.get("class_hist", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.get("word_hist", F.lit(i))).alias(f"w{i}") for i in range(width)]
    agg = good.groupBy("ref_lang").agg(F.count(F.lit(1)).alias("ref_docs"), *sums)
    return agg.select("ref_lang", "ref_docs", F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("ref_class"),
                      F.array(*[f"w{i}" for i in range(width)]).alias("ref_word"))


def js_distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance of two count arrays, in bits; null when either is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    p = F.transform(left, lambda x: x / total(left))
    q = F.transform(right, lambda x: x / total(right))
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    parts = F.zip_with(p, q, lambda x, y: (term(x, (x + y) / 2) + term(y, (x + y) / 2)) / 2)
    ok = (total(left) > 0) & (total(right) > 0)
    return F.when(ok, F.sqrt(F.greatest(total(parts), F.lit(0.0))))


def judge(docs: DataFrame, carry: list[str], scratch: Scratch, *, min_chars: int = MIN_CHARS,
          min_words: int = MIN_WORDS, min_reference: int = MIN_REFERENCE,
          class_limit: tuple[float, float] = CLASS_LIMIT,
          word_limit: tuple[float, float] = WORD_LIMIT) -> DataFrame:
    """``carry`` columns and the result columns of each row of ``docs`` (text, lang).

    The text is read once: counts and histograms go to a written table that serves both
    the references (a sum per language) and the verdicts. The references are a written
    table too: the join knows their size and broadcasts them only if they are small."""
    carry = [c for c in carry if c not in RESERVED]
    m = scratch.put(measured(docs, carry), "measured")
    known = scratch.put(references(m).where(F.col("ref_docs") >= min_reference), "references")
    return verdicts(m, known, carry, min_chars, min_words, class_limit, word_limit)


def verdicts(m: DataFrame, known: DataFrame, carry: list[str], min_chars: int, min_words: int,
             class_limit: tuple[float, float], word_limit: tuple[float, float]) -> DataFrame:
    """``carry`` and result columns of ``measured`` rows, by the references of their languages."""
    joined = m.join(known, "ref_lang", "left")
    chars = F.aggregate("class_hist", F.lit(0).cast("long"), lambda s, x: s + x)
    class_d = F.when(chars >= min_chars, js_distance(F.col("class_hist"), F.col("ref_class")))
    width = F.size("word_hist")
    word_d = F.when((width > 0) & (F.col("n_words") >= min_words),
                    js_distance(F.col("word_hist"), F.slice("ref_word", F.lit(1), F.greatest(width, F.lit(1)))))
    out = joined.withColumn("class_distance", class_d).withColumn("word_distance", word_d)
    out = out.withColumn("base_failed", base_failed())
    allowed = lambda limit: limit[0] + limit[1] / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    fits = (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= allowed(class_limit)) & (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) <= allowed(word_limit))
    out = out.withColumn("kept", ~F.col("base_failed") & fits)
    return out.select(*[F.col(f"`{c}`") for c in carry], *RESULT)


def keep(docs: DataFrame, scratch: Scratch, *, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS,
         min_reference: int = MIN_REFERENCE, class_limit: tuple[float, float] = CLASS_LIMIT,
         word_limit: tuple[float, float] = WORD_LIMIT) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns. Rows are measured once
    for the references and again for their verdicts, so that no text is written; a text goes to
    Python and back once each time. No join by id is needed and rows that share an id are
    judged apart."""
    own = [{"text": "_text", "lang": "_lang"}.get(c.lower(), f"_c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, own)])
    known = scratch.put(references(counted(rows.select("_text", "_lang"), [])).where(F.col("ref_docs") >= min_reference), "references")
    judged = verdicts(counted(rows, own), known, own, min_chars, min_words, class_limit, word_limit)
    return judged.where("kept").select(*[F.col(n).alias(c) for c, n in zip(docs.columns, own)])
