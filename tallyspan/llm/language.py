"""Problem 9: the language of each document and of each stretch of a mixed one.

String-kernel classification. Sentences are compared by a blended-spectrum
presence kernel: the cosine of the sets of character n-grams of orders 1 to 4,
hashed into ``BUCKETS``. A Nyström map onto ``LANDMARKS`` sentences and a
one-versus-rest kernel ridge regression are fitted on a bounded sample of
labelled documents; labels are noisy, so the sentences are relabelled by a
first fit and fitted again. The fitted expansion over landmarks is folded into
one matrix (buckets x languages), and sentences are scored in batches by the
product of their sparse presence rows with it.

Scoring is one pass over the documents without shuffle; within a document the
best path over its sentences, with a cost for each change of language, gives
the stretches. Only the fitted matrix is broadcast; its size is fixed.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import regex
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyspan.functions.text import strip_accents
from tallyspan.session import ship_package

BUCKETS = 1 << 14
ORDERS = (1, 2, 3, 4)
LANDMARKS = 400
#: What the classifier is fitted on at most: labelled documents per language, sentences in all, sentences per document, and files of the table.
FIT_DOCUMENTS, FIT_SENTENCES, PER_DOCUMENT, FIT_FILES = 400, 8000, 16, 64
RIDGE = 1.0
#: Texts whose presence is held at once.
BLOCK = 512
#: Cost of a change of language between sentences, and letters from which a sentence counts in full.
CHANGE, FULL_LETTERS = 0.42, 55
#: Share of its weight that a short line without an end mark keeps (headings, rows of tables).
FRAGMENT = 0.3

# Names and codes of the languages.
LANGUAGE_NAMES = {
    "es": ("es", "spa", "esp", "espanol", "castellano", "spanish", "espagnol", "spanisch", "espanhol"),
    "en": ("en", "eng", "ingles", "english", "anglais", "englisch"),
    "pt": ("pt", "por", "portugues", "portuguese", "portugais", "portugiesisch"),
    "fr": ("fr", "fra", "fre", "frances", "french", "francais", "franzosisch"),
    "de": ("de", "deu", "ger", "aleman", "german", "deutsch", "allemand", "alemao"),
}
LANGUAGES = tuple(LANGUAGE_NAMES)


def language_code(label: Column) -> Column:
    """Code of a language label in any spelling, with or without a country; null for placeholders and unknown names."""
    plain = F.regexp_extract(F.lower(strip_accents(F.trim(label))), r"^([a-z]+)(?:[-_ (].*)?$", 1)
    table = F.create_map(*[F.lit(x) for code, names in LANGUAGE_NAMES.items() for n in names for x in (n, code)])
    return F.try_element_at(table, plain)


# Abbreviations whose point ends no sentence.
ABBREVIATIONS = frozenset("S.A S.p.A Ltda Ltd Cía Cia Inc Corp Nr No Art Sr Sra Dr".split())
_END = regex.compile(r"\r?\n\s*|[.!?…][\"»”')\]]*(\s+)(?=[¿¡\"«“(]*\p{Lu})")
_MARKS = frozenset(".!?…")
_NOT_LETTER = re.compile(r"[\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text: lines, and within them ends of sentences before a capital."""
    cuts, at = [], 0
    for m in _END.finditer(text):
        end = m.start(1) if m[1] is not None else m.start()
        if m[1] is not None and text[m.start()] == "." and text[max(at, text.rfind(" ", at, m.start()) + 1) : m.start()] in ABBREVIATIONS:
            continue
        if end > at:
            cuts.append((at, end))
        at = m.end()
    if at < len(text):
        cuts.append((at, len(text)))
    return cuts


def letters_only(text: str) -> str:
    """Lower case in composed form; runs of characters that are no letters become one blank; blanks around."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return " " + _NOT_LETTER.sub(" ", text.lower()).strip() + " "


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def presence(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of the n-grams of each text, as bucket ids and row starts (CSR)."""
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    rows, ends = np.repeat(np.arange(len(texts), dtype=np.int64), sizes), np.repeat(np.cumsum(sizes), sizes)
    place, keys = np.arange(len(codes), dtype=np.int64), []
    rolled = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        rolled = rolled[:m] * np.uint64(1_000_003) + codes[n - 1 :]
        if n in ORDERS:
            inside = place[:m] + n <= ends[:m]
            bucket = ((rolled + np.uint64(n)) * _MULTIPLIER) >> np.uint64(64 - BUCKETS.bit_length() + 1)
            keys.append(rows[:m][inside] * BUCKETS + bucket[inside].astype(np.int64))
    flat = np.concatenate(keys) if keys else np.empty(0, dtype=np.int64)
    if len(texts) * BUCKETS < 1 << 31:
        flat = flat.astype(np.int32)  # sorts much faster
    flat.sort()
    if len(flat):
        flat = flat[np.concatenate([[True], flat[1:] != flat[:-1]])].astype(np.int64)
    starts = np.searchsorted(flat, np.arange(len(texts) + 1, dtype=np.int64) * BUCKETS)
    return (flat % BUCKETS).astype(np.int64), starts


def kernel_rows(texts: Sequence[str]) -> np.ndarray:
    """Dense unit rows of presence; their products are the kernel."""
    buckets, starts = presence(texts)
    counts = np.diff(starts)
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    out[np.repeat(np.arange(len(texts)), counts), buckets] = np.repeat(1 / np.sqrt(np.maximum(counts, 1)), counts)
    return out


@dataclass(frozen=True)
class Classifier:
    """The folded expansion: ``weights`` (buckets x languages)."""

    weights: np.ndarray
    languages: tuple[str, ...] = LANGUAGES

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """Ridge scores (texts x languages): products of unit presence rows with the weights, in blocks of BLOCK."""
        if len(texts) > BLOCK:
            return np.concatenate([self.scores(texts[at : at + BLOCK]) for at in range(0, len(texts), BLOCK)])
        buckets, starts = presence(texts)
        counts = np.diff(starts)
        out = np.zeros((len(texts), self.weights.shape[1]))
        some = np.flatnonzero(counts)
        if len(some):
            out[some] = np.add.reduceat(self.weights[buckets], starts[:-1][some], axis=0)
        return out / np.sqrt(np.maximum(counts, 1))[:, None]


def _fit_once(rows: list[str], y: np.ndarray, n_classes: int) -> np.ndarray:
    """Weights of one Nyström kernel ridge fit. Landmarks are spread evenly over the classes."""
    picked: list[int] = []
    for c in range(n_classes):
        at = np.flatnonzero(y == c)
        if len(at):
            picked += at[np.unique(np.linspace(0, len(at) - 1, max(1, LANDMARKS // n_classes)).astype(int))].tolist()
    marks = kernel_rows([rows[i] for i in picked])
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = value > 1e-6
    root = vector[:, keep] / np.sqrt(value[keep])
    size = int(keep.sum())
    gram, cross = np.eye(size) * RIDGE, np.zeros((size, n_classes))
    weight = len(y) / (n_classes * np.maximum(np.bincount(y, minlength=n_classes), 1))
    for at in range(0, len(rows), 256):
        z = (kernel_rows(rows[at : at + 256]) @ marks.T) @ root
        part = y[at : at + 256]
        w = weight[part][:, None]
        target = np.where(part[:, None] == np.arange(n_classes), 1.0, -1.0)
        gram += z.T @ (z * w)
        cross += z.T @ (target * w)
    return (marks.T @ (root @ np.linalg.solve(gram, cross))).astype(np.float32)


def fit_sentences(rows: list[str], label: np.ndarray, doc: np.ndarray) -> Classifier:
    """Fit on normalised sentences with the noisy labels of their documents. Languages without a sentence are never given.

    Two rounds fit the full sentences, relabel them and drop the unsure ones.
    Headings and rows of tables say too little to be judged alone: they take
    the language that their document's full sentences agree on, and are left
    out where there is none.
    """
    if not rows:
        return Classifier(np.zeros((BUCKETS, len(LANGUAGES)), dtype=np.float32))
    size = np.array([len(r.replace(" ", "")) for r in rows])
    at = np.flatnonzero(size >= FULL_LETTERS) if (size >= FULL_LETTERS).any() else np.arange(len(rows))
    y = label[at]
    for _ in range(2):
        texts = [rows[i] for i in at]
        scored = Classifier(_fit_once(texts, y, len(LANGUAGES))).scores(texts)
        best = np.sort(scored, axis=1)
        sure = best[:, -1] - best[:, -2] > 0.25
        if not sure.any():
            break
        at, y = at[sure], scored.argmax(axis=1)[sure]
    told: dict[int, set[int]] = {}
    for d, lang in zip(doc[at].tolist(), y.tolist()):
        told.setdefault(d, set()).add(lang)
    short = [i for i in range(len(rows)) if size[i] < FULL_LETTERS and len(told.get(int(doc[i]), ())) == 1]
    more = np.array([next(iter(told[int(doc[i])])) for i in short], dtype=int)
    return Classifier(_fit_once([rows[i] for i in [*at, *short]], np.concatenate([y, more]), len(LANGUAGES)))


def training_sentences(text: str) -> list[tuple[int, str]]:
    """(hash, normalised sentence) of a text's sentences; the shortest tell nothing."""
    plain = (letters_only(text[a:b]) for a, b in sentences(text))
    return [(zlib.crc32(s.encode("utf-8", "replace")), s) for s in plain if len(s) >= 10]


def _fitted(kept: list[tuple[str, int, str]]) -> Classifier:
    """Fit on (language, document, sentence) rows."""
    return fit_sentences([s for _, _, s in kept], np.array([LANGUAGES.index(lang) for lang, _, _ in kept], dtype=int), np.array([d for _, d, _ in kept], dtype=np.int64))


def fit(samples: Sequence[tuple[str, str]]) -> Classifier:
    """Fit on (language, text) samples: of each language FIT_SENTENCES / 5 sentences, of each text PER_DOCUMENT, those with the smallest hashes."""
    kept = []
    for lang in LANGUAGES:
        of_lang = [(lang, d, s) for d, (x, text) in enumerate(samples) if x == lang for _, s in sorted(training_sentences(text))[:PER_DOCUMENT]]
        kept += of_lang[: FIT_SENTENCES // len(LANGUAGES)]
    return _fitted(kept)


def _of_few_files(df: DataFrame, most: int) -> DataFrame:
    """The rows of the ``most`` files with the smallest hashes of their paths, where ``df`` reads more files than that; the other files aren't opened."""
    paths = df.inputFiles()
    if len(paths) <= most:
        return df
    picked = sorted(paths, key=lambda p: (zlib.crc32(p.encode()), p))[:most]
    local = [p.replace("file:///", "file:/", 1) for p in picked]  # how the metadata column writes local paths
    try:
        return df.where(F.col("_metadata.file_path").isin(*{*picked, *local}))
    except AnalysisException:  # not a plain file source: all its rows are looked at
        return df


def fit_on(df: DataFrame, doc_id: str, text: str, label: str, per_language: int = FIT_DOCUMENTS, files: int = FIT_FILES) -> Classifier:
    """Fit on at most ``per_language`` labelled documents of each language, those with the smallest hash of their id among ``files`` files at most.

    One scan of the label column counts each language; from the counts follows
    a bound of the hash below which twice the wanted documents lie, and one
    scan of the texts cuts those into sentences on the executors. The driver
    gets FIT_SENTENCES sentences at most.
    """
    ship_package(df.sparkSession)
    code, hashed = language_code(F.col(label)), F.xxhash64(F.col(doc_id))
    few = _of_few_files(df, files)
    there = {r[0]: r[1] for r in few.groupBy(code.alias("code")).count().where("code is not null").collect()}
    if not there:
        return _fitted([])
    bound = lambda n: min(2**63 - 1, int(2**64 * 2 * per_language / n) - 2**63)
    below = F.create_map(*[F.lit(x) for lang, n in sorted(there.items()) for x in (lang, bound(n))])
    rows = few.select(code.alias("lang"), hashed.alias("doc"), F.col(text).alias("text")).where(F.col("text").isNotNull() & (F.col("doc") <= F.try_element_at(below, F.col("lang"))))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(lang, d, h, s) for lang, d, t in zip(batch["lang"], batch["doc"], batch["text"]) for h, s in sorted(training_sentences(t))[:PER_DOCUMENT]]
            yield pd.DataFrame(found, columns=["lang", "doc", "hash", "sentence"])

    pieces = rows.mapInPandas(cut, "lang string, doc bigint, hash bigint, sentence string")
    by_lang = W.partitionBy("lang")
    ranked = pieces.withColumn("d", F.dense_rank().over(by_lang.orderBy("doc"))).withColumn("n", F.row_number().over(by_lang.orderBy("doc", "hash", "sentence")))
    wanted = (F.col("d") <= per_language) & (F.col("n") <= FIT_SENTENCES // len(LANGUAGES))
    return _fitted(sorted(map(tuple, ranked.where(wanted).select("lang", "doc", "sentence").collect())))


def best_path(scores: np.ndarray, weights: np.ndarray) -> list[int]:
    """Language of each sentence: the path of greatest weighted score with a cost per change."""
    e = scores * weights[:, None]
    total, back = e[0], []
    for row in e[1:]:
        top = int(total.argmax())
        moved = total[top] - CHANGE
        stay = total >= moved
        back.append(np.where(stay, np.arange(len(total)), top))
        total = np.where(stay, total, moved) + row
    path = [int(total.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def stretches(texts: Sequence[str | None], model: Classifier) -> list[list[tuple]]:
    """For each text its stretches (language, confidence, start, end, letters); none for a text without letters."""
    spans: list[tuple[int, int, int]] = []
    plain: list[str] = []
    ended: list[bool] = []
    for i, t in enumerate(texts):
        for a, b in sentences(t) if t else []:
            s = letters_only(t[a:b])
            if len(s) > 2:
                spans.append((i, a, b))
                plain.append(s)
                ended.append(t[a:b].rstrip(" \"»”')]\u200b")[-1:] in _MARKS)
    out: list[list[tuple]] = [[] for _ in texts]
    if not plain:
        return out
    scores = model.scores(plain)
    count = np.array([len(s.replace(" ", "")) for s in plain])
    weight = np.minimum(1.0, count / FULL_LETTERS) ** 1.5
    weight = np.where(np.array(ended) | (count >= FULL_LETTERS), weight, weight * FRAGMENT)
    top = scores.argmax(axis=1)
    border = np.flatnonzero(np.diff([-1, *(s[0] for s in spans), -1]))
    found: list[tuple[int, int, int]] = []
    for lo, hi in pairwise(border.tolist()):
        if (top[lo:hi] == top[lo]).all():
            found.append((int(top[lo]), lo, hi))
            continue
        path = best_path(scores[lo:hi], weight[lo:hi])
        turns = [0, *(k for k in range(1, hi - lo) if path[k] != path[k - 1]), hi - lo]
        found += [(path[k], lo + k, lo + m) for k, m in pairwise(turns)]
    lang, first, last = (np.array(x) for x in zip(*found))
    sums = lambda x: (c := np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0)]))[last] - c[first]
    # confidence: softmax share of the language over a stretch's weighted mean scores
    mean = sums(scores * weight[:, None]) / np.maximum(sums(weight), 1e-9)[:, None]
    share = np.exp(4 * (mean - mean.max(axis=1, keepdims=True)))
    sure, letters = share[np.arange(len(lang)), lang] / share.sum(axis=1), sums(count).astype(int)
    for k, (l, x, y) in enumerate(found):
        out[spans[x][0]].append((model.languages[l], float(sure[k]), spans[x][1], spans[y - 1][2], int(letters[k])))
    return out


def main_language(parts: list[tuple]) -> tuple[str, float] | None:
    """The language with most letters (ties: by code) and its letter-weighted confidence."""
    letters: dict[str, int] = {}
    for lang, _, _, _, n in parts:
        letters[lang] = letters.get(lang, 0) + n
    if not letters:
        return None
    top = min(letters, key=lambda k: (-letters[k], k))
    return top, sum(c * n for lang, c, _, _, n in parts if lang == top) / max(1, letters[top])


_SEGMENT = "doc_id bigint, seg_no bigint, lang string, confidence double, start_char bigint, end_char bigint, letters bigint, labelled string, mixed boolean"


def detect(df: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", model: Classifier | None = None) -> DataFrame:
    """One row per document (seg_no -1: its main language) and per stretch (from 0, in order of the text).

    ``labelled`` is the code that the document's label names, null if none;
    ``mixed`` says whether the document has several stretches. A
    null, empty or letterless text has one row of seg_no -1 with a null
    language and confidence 0. Other columns of the input are ignored.
    """
    spark = df.sparkSession
    ship_package(spark)
    model = model or fit_on(df, doc_id, text, label)
    sent = spark.sparkContext.broadcast(model)
    slim = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), language_code(F.col(label)).alias("labelled"), F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 250):
                part = batch.iloc[at : at + 250]
                out = []
                for d, label_, parts, t in zip(part["doc_id"], part["labelled"], stretches(part["text"].tolist(), sent.value), part["text"]):
                    main = main_language(parts)
                    out.append((d, -1, *(main or (None, 0.0)), 0, len(t or ""), sum(p[4] for p in parts), label_, len(parts) > 1))
                    out += [(d, k, *p, label_, len(parts) > 1) for k, p in enumerate(parts)]
                rows = pd.DataFrame(out, columns=["doc_id", "seg_no", "lang", "confidence", "start_char", "end_char", "letters", "labelled", "mixed"])
                yield rows.astype({"doc_id": "Int64"})

    return slim.mapInPandas(run, _SEGMENT)
