"""Quality rules: repetition counts and divergence of a document from its language."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from idtrail.llm.common import arrow_schema, unused
from idtrail.session import staged

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
PUNCTUATION = b".,;:!?'\"()[]{}-_/\\@#*$%&|<>=+~^`"
#: Classes of code points, told by their first UTF-8 byte; 255 marks the bytes that continue one.
CLASSES = ("vowel", "consonant", "upper", "digit", "space", "stop", "mark", "control", "latin", "two_bytes", "three_bytes", "four_bytes")


def _byte_classes() -> np.ndarray:
    out = np.full(256, 7, np.uint8)
    for k, chars in enumerate((b"aeiou", b"bcdfghjklmnpqrstvwxyz", bytes(range(65, 91)), b"0123456789", SPACES, b".,;:!?'\"()-")):
        out[list(chars)] = k
    out[[c for c in range(33, 127) if out[c] == 7]] = 6
    out[0x80:0xC0] = 255
    out[0xC0:0xCA], out[0xCA:0xE0], out[0xE0:0xF0], out[0xF0:] = 8, 9, 10, 11
    return out


BYTE_CLASS = _byte_classes()
TO_SPACE = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(BYTE_CLASS[np.frombuffer(text, np.uint8)], minlength=256)[: len(CLASSES)]


def plain_words(text: bytes) -> list[bytes]:
    """Words for the histograms: A-Z folded, ASCII punctuation cut off."""
    return text.lower().translate(TO_SPACE).split()


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a run of ``width`` words found twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    found = np.zeros(n, bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    at = np.flatnonzero(found).tolist()
    counts = Counter(tuple(words[i : i + width]) for i in at)  # equal hashes of different words don't count
    starts = np.array([i for i in at if counts[tuple(words[i : i + width])] > 1], np.int64)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int, list[bytes]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the words."""
    words = text.split()
    inside = text.translate(None, SPACES)
    chars = int((np.frombuffer(inside, np.uint8) & 0xC0 != 0x80).sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), words


def divergence(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (root of the divergence, base 2) of two histograms; 0 if either is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, d / 2)))


def _docs(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), lang.alias("lang")
    )


def most_frequent(words: DataFrame, most: int, *by: str) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("n"), "word"))
    return words.withColumn("rank", rank).where(F.col("rank") <= most).drop("rank")


def language_references(docs: DataFrame, common: int = 100) -> DataFrame:
    """``lang, classes, words, counts`` for each language, whatever their number: its class histogram, its ``common`` most frequent words,
    and how often each occurs, with all other words last.

    Counted over the whole of ``docs`` (``doc_id, text, lang``) and written once; nothing is sent to the driver.
    """
    out = arrow_schema("lang string, word binary, n long")

    def count(batches):
        for batch in batches:
            words: dict[str, Counter] = {}
            classes: dict[str, np.ndarray] = {}
            for text, lang in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("lang").to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(plain_words(text))
                classes[lang] = classes.get(lang, 0) + class_counts(text)
            rows = [(lang, w, n) for lang, c in words.items() for w, n in c.items()]
            # a class is a word that cannot occur: a space and its number
            rows += [(lang, b" %d" % k, int(n)) for lang, c in classes.items() for k, n in enumerate(c)]
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(("lang", "word", "n"), zip(*rows, strict=True), strict=True)), schema=out)

    counted = docs.mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = staged(counted)
    is_class = F.col("word").cast("string").startswith(" ")
    words = counted.where(~is_class)
    # first among the words of one hash, so that what meets in a language's task is 64 lists and not one for each partition
    ranked = most_frequent(most_frequent(words.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(64))), common, "lang", "salt").drop("salt"), common, "lang")
    top = ranked.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "word"))).alias("top"))
    classes = counted.where(is_class).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct(F.trim(F.col("word").cast("string")).cast("int").alias("k"), "n"))).alias("classes"),
    )
    sums = words.groupBy("lang").agg(F.sum("n").alias("total"))
    told = classes.join(top, "lang", "left").join(sums, "lang", "left")  # a language without words has classes only
    counts = F.transform(F.coalesce("top", F.array()), lambda x: -x["less"])
    rest = F.coalesce("total", F.lit(0)) - F.aggregate(counts, F.lit(0).cast("long"), lambda x, y: x + y)
    return staged(told.select(
        "lang", F.transform("classes", lambda x: x["n"]).alias("classes"), F.transform(F.coalesce("top", F.array()), lambda x: x["word"]).alias("words"),
        F.concat(counts, F.array(rest)).alias("counts"),
    ))


REFERENCES = 1_000  # languages whose references a task keeps


def judge(
    docs: DataFrame, common: int = 100, min_chars: int = 400, min_words: int = 50, max_class: float = 0.25, max_common: float = 0.5, max_sum: float = 0.6,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """A row for each row of ``docs``: counts, base rules, distances from the document's language and the verdict.

    ``class_distance`` and ``common_distance`` are Jensen-Shannon distances of the character classes and of the ``common``
    most frequent words (and all others as one) from those of all documents of that language. A document of at least
    ``min_chars`` code points is dropped over ``max_class``, one of at least ``min_words`` words over ``max_common``, one that is
    both if the two distances add up to more than ``max_sum``; shorter ones vary too much to be judged so and their distance is null.

    Null or empty text: no words, fails the base rule of 10 words. Null language: a language of its own. Without the
    language column all documents are one language. Null ids and repeated rows: each row is judged. Empty table: no rows.
    """
    rows = _docs(docs, id_col, text_col, lang_col)
    # few languages: Spark broadcasts the stored table by its size; many: a join that it can split at a frequent language
    rows = rows.join(language_references(rows, common), "lang")
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, class_distance double, common_distance double"
    )
    arrow = arrow_schema(schema)

    def score(batches):
        references: dict[str, tuple[np.ndarray, dict[bytes, int], np.ndarray]] = {}
        for batch in batches:
            out = []
            columns = [batch.column(c) for c in ("classes", "words", "counts")]
            ids, texts, langs = (batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("lang").to_pylist())
            for at, (doc_id, text, lang) in enumerate(zip(ids, texts, langs, strict=True)):
                if lang not in references:
                    if len(references) >= REFERENCES:
                        references.clear()
                    classes, top, counts = (c[at].as_py() for c in columns)
                    references[lang] = np.array(classes, float), {w: k for k, w in enumerate(top)}, np.array(counts, float)
                n, chars, symbols, lines, repeated, words = base_counts(text)
                failed = n < 10 or 100 * repeated > 20 * n
                classes, ranks, histogram = references[lang]
                counts = class_counts(text)
                far = divergence(counts, classes) if counts.sum() >= min_chars else None
                odd = None
                if n >= min_words:
                    plain = plain_words(text)
                    mine = np.zeros(len(histogram))
                    for k in map(ranks.get, plain):
                        if k is not None:
                            mine[k] += 1
                    mine[-1] = len(plain) - mine.sum()
                    odd = divergence(mine, histogram)
                off = (far is not None and far > max_class) or (odd is not None and odd > max_common)
                off = off or (far is not None and odd is not None and far + odd > max_sum)
                kept = not failed and not off
                out.append((doc_id, n, chars, symbols, lines, repeated, failed, kept, far, odd))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, zip(*out, strict=True), strict=True)), schema=arrow)

    return rows.mapInArrow(score, schema)


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps. Rows of one text and language share a verdict, so that is the key."""
    key, kept_key = unused(docs, "key"), unused(docs, "kept_key")
    keyed = docs.withColumn(key, F.xxhash64(text_col, lang_col) if lang_col in docs.columns else F.xxhash64(text_col))
    kept = staged(judge(keyed, id_col=key, text_col=text_col, lang_col=lang_col, **options).where("kept").select(F.col("doc_id").alias(kept_key)).distinct())
    return keyed.join(kept, F.col(key) == F.col(kept_key), "left_semi").drop(key)
