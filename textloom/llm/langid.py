"""Language of sentences: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained on a small labelled table with follow-the-regularised-leader and elastic-net penalties, calibrated by a
temperature from cross-validation. Term frequencies are shares of a sentence's n-grams and n-grams don't cross words,
so a sentence's scores are the mean of its words' score rows; the rows of words are remembered, which makes scoring a
table look-up. Every text is scored whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.words import fold
from textloom.session import ship

MAX_TRAINING_TEXTS = 20_000  # bound on the clean labelled rows that the model is fitted on
PER_STRATUM = 150  # bound on further labelled rows for each language and stratum (role)

_FENCE = re.compile(r"```.*?(?:```|\Z)", re.S)
_LOG = re.compile(r"^[ \t>]*(?:\[?\d{4}-\d\d-\d\d[T ])?\[?\d{1,2}:\d\d:\d\d\b.*$|^[ \t>]*(?:at [\w.$]+\(.*\)|Traceback .*|\[?(?:DEBUG|INFO|WARN(?:ING)?|ERR(?:OR)?|FATAL|TRACE)\b.*=.*)$", re.M)
_NOISE = re.compile(r"(?:https?://|www\.)\S+|\S+@\S+\.\S+|<[^<>\n]{1,80}>|`[^`\n]{1,80}`")
_DIGIT = re.compile(r"\d")
_CODE = re.compile(r"(?<![A-Za-z])[A-Za-z]*[-_/.]*\d[\w./:-]*", re.A)
# ends of sentences: a terminator before white space, an empty line, a line that starts a list item
_END = re.compile(r"(?<=[.!?।॥…。？！])[\"'”’»)\]]*\s+|\s*\n\s*\n\s*|\n(?=[ \t>]*(?:\d{1,3}[.)]|[-*•–])[ \t])")
_STOP = re.compile(r"[.!?।॥…。？！][\"'”’»)\]]*\s+")
# letters and combining marks of the scripts at hand, then anything else that is a letter
_TOKEN = re.compile(r"[^\W\d_]+(?:[̀-ͯऀ-ॣ஁-்]+[^\W\d_]*)*")
_LETTERS = re.compile("[a-z]+")  # the same in text without other letters
_LIST_NO = re.compile(r"^\s*(?:>\s*)*\d{1,3}[.)]\s*$")

FILLERS = frozenset(
    """n/a na nil none null nan undefined empty blank unknown tbd todo void missing - -- --- . .. ... … ? ?? ??? {} [] () "" '' — – _ * # x xx
    (blank) (empty) (none) (null) <empty> <null> <none> <blank> [empty] [blank] [none] [null] [no-response] <no-response> (no-response)
    [no-answer] (no-answer) no-response no-answer no-reply no-content no-text [no-content] (no-content) [no-reply] [removed] [deleted] (removed) (deleted)
    [content-removed] not-available not-applicable not-provided""".split()
)  # contents that stand for none, in lower case with - for spaces


def is_filler(text: str) -> bool:
    """A text that says nothing: blank, a stand-in for no content, or no letter and no digit at all."""
    if len(text) > 200:  # longer than any stand-in, however much space is around it
        return not any(c.isalnum() for c in text)
    t = fold(text).strip()
    if len(t) > 40:
        return not any(c.isalnum() for c in t)
    key = re.sub(r"\s+", "-", t)
    return not any(c.isalnum() for c in key) or key in FILLERS or key.rstrip(".!…") in FILLERS


def clean(text: str) -> str:
    """The text without pasted logs, code, addresses and markup, which have no language."""
    t = text
    if "```" in t:
        t = _FENCE.sub("\n\n", t)
    if ":" in t or "=" in t:
        t = _LOG.sub("\n\n", t)
    if "@" in t or "<" in t or "`" in t or "//" in t or "www" in t:
        t = _NOISE.sub(" ", t)
    return t


def split_sentences(text: str) -> list[str]:
    t = clean(text)
    if "\n" in t:
        return [s for s in _END.split(t) if s and not _LIST_NO.match(s)]
    # within a line only the first kind of end; a search that starts at a terminator is the faster one
    out, at = [], 0
    for m in _STOP.finditer(t):
        out.append(t[at : m.start() + 1])
        at = m.end()
    out.append(t[at:])
    return [s for s in out if s and not _LIST_NO.match(s)]


_TAMIL, _DEVANAGARI = re.compile("[஀-௿]"), re.compile("[ऀ-ॿ]")
_CAPITAL = re.compile(r"\b[A-Z][a-z]+\b")


def sentence_tokens(sentence: str) -> list[str]:
    """Lower-case word tokens; codes are left out, and so are capitalised Latin names inside a sentence of another script."""
    s = _CODE.sub(" ", sentence) if _DIGIT.search(sentence) else sentence
    if not s.isascii():
        if _TAMIL.search(s) or _DEVANAGARI.search(s):
            s = _CAPITAL.sub(" ", s)
        s = fold(s)
    else:
        return _LETTERS.findall(s.lower())
    return _TOKEN.findall(s)


_LATIN, _TAMIL_BIT, _DEVANAGARI_BIT, _OTHER = 1, 2, 4, 8


def _script(token: str) -> int:
    """Script of a token as a bit; none for a single ASCII letter."""
    c = token[0]
    if len(token) == 1 and c < "\x80":
        return 0
    return _LATIN if c < "ʰ" else _TAMIL_BIT if "஀" <= c <= "௿" else _DEVANAGARI_BIT if "ऀ" <= c <= "ॿ" else _OTHER


def _scripts(tokens: list[str]) -> str:
    """Feature that names the scripts of a sentence."""
    bits = 0
    for t in tokens:
        bits |= _script(t)
    return f"\x02{bits}"


def _grams(token: str, longest: int = 4) -> list[str]:
    w = f" {token} "
    return [w[i : i + n] for n in range(2, longest + 1) for i in range(len(w) - n + 1)] or [w]


@dataclass
class Model:
    classes: list[str]
    index: dict[str, int]
    weights: np.ndarray  # features x classes, idf folded in
    bias: np.ndarray
    temperature: float = 1.0
    rows: dict[str, int] = field(default_factory=dict, repr=False)
    table: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "table")} | {"rows": {}, "table": None}

    def word_row(self, token: str) -> np.ndarray:
        """Summed weights of the word's n-grams, how many n-grams those are, and its script."""
        grams = _grams(token)
        at = [i for g in grams if (i := self.index.get(g)) is not None]
        return np.append(self.weights[at].sum(axis=0) if at else np.zeros(len(self.classes)), [len(grams), _script(token)]).astype(np.float32)

    def scores(self, sentences: list[list[str]]) -> np.ndarray:
        """Logits of tokenised sentences (none empty)."""
        if len(self.rows) > 300_000 or self.table is None:
            self.rows.clear()
            self.table = np.zeros((4096, len(self.classes) + 2), np.float32)
        rows = self.rows
        ids: list[int] = []
        starts = np.cumsum([0, *(len(s) for s in sentences)])[:-1]
        for s in sentences:
            try:
                ids += [rows[t] for t in s]
            except KeyError:
                for t in s:
                    i = rows.get(t)
                    if i is None:
                        i = rows[t] = len(rows)
                        if i == len(self.table):
                            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                        self.table[i] = self.word_row(t)
                    ids.append(i)
        picked = self.table[ids]
        sums = np.add.reduceat(picked[:, :-1], starts, axis=0)
        bits = np.bitwise_or.reduceat(picked[:, -1].astype(np.uint8), starts)
        mix = np.array([self.index.get(f"\x02{k}", -1) for k in range(16)])[bits]
        out = sums[:, :-1] / sums[:, -1:] + self.bias
        return out + np.where(mix[:, None] >= 0, self.weights[mix], 0)

    def predict(self, sentences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Class numbers and calibrated confidences."""
        z = self.scores(sentences) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        p = z / z.sum(axis=1, keepdims=True)
        return p.argmax(axis=1), p.max(axis=1)


def _vector(tokens: list[str], index: dict[str, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = Counter(i for t in tokens for g in _grams(t) if (i := index.get(g)) is not None)
    total = sum(len(_grams(t)) for t in tokens)
    at = np.fromiter(counts, np.int64, len(counts))
    x = np.fromiter(counts.values(), np.float64, len(counts)) / max(total, 1) * idf[at]
    mix = index.get(_scripts(tokens))
    return (np.append(at, mix), np.append(x, 1.0)) if mix is not None else (at, x)


def _ftrl(data: list, n_features: int, n_classes: int, alpha: float, l1: float, l2: float, epochs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by per-coordinate FTRL-proximal with L1 and L2 penalties; the bias isn't penalised by L1."""
    z, n = np.zeros((n_features + 1, n_classes)), np.zeros((n_features + 1, n_classes))
    rng = np.random.default_rng(seed)

    def weight(at: np.ndarray) -> np.ndarray:
        lasso = np.where(at[:, None] == n_features, 0.0, l1)
        w = -(z[at] - np.sign(z[at]) * lasso) / ((1.0 + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= lasso, 0.0, w)

    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            at, x, y = data[k]
            at, x = np.append(at, n_features), np.append(x, 1.0)
            w = weight(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1.0
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weight(np.arange(n_features + 1))
    return w[:-1], w[-1]


def train(samples: list[tuple[str, str]], alpha: float = 1.0, l1: float = 0.002, l2: float = 0.001, epochs: int = 4, folds: int = 2, seed: int = 7) -> Model:
    """A calibrated model from (language, text) rows; the texts count whole and by sentence. Rows without words are left out."""
    docs: list[tuple[list[str], str, int]] = []
    for k, (lang, text) in enumerate(sorted(samples)):
        parts = [sentence_tokens(s) for s in split_sentences(text or "")]
        whole = [t for p in parts for t in p]
        docs += [(p, lang, k % folds) for p in ([whole, *parts] if len(parts) > 1 else [whole]) if p]
    classes = sorted({lang for _, lang, _ in docs})
    if not classes:
        raise ValueError("no labelled text")
    df = Counter(g for p, _, _ in docs for g in {*(g for t in p for g in _grams(t)), _scripts(p)})
    index = {g: i for i, g in enumerate(sorted(g for g, c in df.items() if c > 1 or g[0] == "\x02"))}
    idf = np.ones(len(index))
    for g, i in index.items():
        # shares of n-grams are small; the factor brings inputs to the order of one, for which the learning rate is meant
        idf[i] = 1.0 if g[0] == "\x02" else 5.0 * math.log((1 + len(docs)) / (1 + df[g])) + 1.0
    data = [(*_vector(p, index, idf), classes.index(lang)) for p, lang, _ in docs]

    def fit(rows: list) -> Model:
        w, b = _ftrl(rows, len(index), len(classes), alpha, l1, l2, epochs, seed)
        return Model(classes, index, (w * idf[:, None]).astype(np.float32), b.astype(np.float32))

    logits, truth = [], []
    for f in range(folds):
        held = [k for k, d in enumerate(docs) if d[2] == f]
        if held and len(held) < len(docs):
            m = fit([data[k] for k in range(len(docs)) if docs[k][2] != f])
            logits.append(m.scores([docs[k][0] for k in held]))
            truth += [data[k][2] for k in held]
    model = fit(data)
    if logits:
        z, y = np.concatenate(logits).astype(np.float64), np.array(truth)

        def loss(t: float) -> float:
            s = z / t
            s -= s.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]))

        model.temperature = min((2.0 ** (k / 4) for k in range(-16, 17)), key=loss)
    return model


def segments(model: Model, texts: list[str | None], doubtful: float = 0.5) -> list[list[tuple[str, float, int]]]:
    """For each text its runs of sentences in one language: (language, confidence, sentences), in order.

    Sentences without words belong to no run. A sentence of under three words that the model doubts goes with the
    sentence before it, or the one after. A run's confidence is the mean over its sentences, weighted by their words.
    """
    flat: list[list[str]] = []
    owner: list[int] = []
    for k, t in enumerate(texts):
        if t:
            for s in split_sentences(t):
                tokens = sentence_tokens(s)
                if tokens and (len(tokens) > 1 or len(tokens[0]) > 1):
                    flat.append(tokens)
                    owner.append(k)
    out: list[list[tuple[str, float, int]]] = [[] for _ in texts]
    if not flat:
        return out
    label, conf = model.predict(flat)
    per: dict[int, list[int]] = {}
    for i, k in enumerate(owner):
        per.setdefault(k, []).append(i)
    for k, rows in per.items():
        langs = [int(label[i]) for i in rows]
        if len(set(langs)) > 1:
            weak = [len(flat[i]) < 3 and conf[i] < doubtful for i in rows]
            for j, w in enumerate(weak):
                if w:
                    near = [x for x in (j - 1, j + 1) if 0 <= x < len(rows) and not weak[x]]
                    if near:
                        langs[j] = langs[near[0]]
        runs: list[list] = []
        for j, i in enumerate(rows):
            words = len(flat[i])
            if runs and runs[-1][0] == langs[j]:
                runs[-1][1] += float(conf[i]) * words
                runs[-1][2] += words
                runs[-1][3] += 1
            else:
                runs.append([langs[j], float(conf[i]) * words, words, 1])
        out[k] = [(model.classes[r[0]], r[1] / r[2], r[3]) for r in runs]
    return out


def agreeing(model: Model, labelled: list[tuple[str, str]], sure: float = 0.95, least: int = 5, share: float = 0.8) -> list[tuple[str, str]]:
    """Of (label, text) rows with doubtful labels the sentences that may teach.

    The whole text reads as its label, and the sentence isn't surely in another language. Where the same sentence stands
    under several labels, two thirds of its rows must have this one. And what a sentence keeps company with overrules both
    model and label: one that stands in ``least`` texts or more, whose other sentences read as one language in ``share`` of
    them, teaches that language. So a short wording that looks foreign to a model of clean samples is put right by the
    texts that it is always found in.
    """
    Key = tuple[str, ...]  # noqa: N806
    taught: list[tuple[str, str, Key]] = []
    votes: Counter[Key] = Counter()
    mine: Counter[tuple[str, Key]] = Counter()
    company: dict[Key, Counter[str]] = {}
    shown: dict[Key, str] = {}
    for lang, text in labelled:
        parts = [(s, t) for s in split_sentences(text or "") if (t := sentence_tokens(s))]
        if not parts or lang not in model.classes:
            continue
        rest = [[x for j, (_, p) in enumerate(parts) if j != i for x in p] for i in range(len(parts))] if len(parts) > 1 else []
        k, conf = model.predict([[t for _, p in parts for t in p], *(p for _, p in parts), *rest])
        n = len(parts)
        for (s, t), c in zip(parts, k[n + 1 :], strict=False):
            company.setdefault(tuple(t), Counter())[model.classes[c]] += 1
            shown[tuple(t)] = s
        if model.classes[k[0]] == lang:
            for (s, t), c, q in zip(parts, k[1 : n + 1], conf[1 : n + 1], strict=True):
                if model.classes[c] == lang or q < sure:
                    taught.append((lang, s, tuple(t)))
                    votes[tuple(t)] += 1
                    mine[lang, tuple(t)] += 1
    settled: dict[Key, str] = {}
    for t, c in company.items():
        lang, n = c.most_common(1)[0]
        if c.total() >= least and n >= share * c.total():
            settled[t] = lang
    out = [(lang, s) for lang, s, t in taught if 3 * mine[lang, t] >= 2 * votes[t] and settled.get(t, lang) == lang]
    # those that the model and the labels alone would not have taught right
    return out + [(lang, shown[t]) for t, lang in settled.items() if not mine[lang, t] for _ in range(company[t][lang])]


_fitted: dict[str, Model] = {}  # the last models of this process, by the rows they were fitted on


def _trained(rows: list[tuple[str, str]], more: list[tuple[str, str]]) -> Model:
    """Model of the clean rows and of the ``more`` rows that agree with it; fitted once for equal rows."""
    mark = hashlib.sha256(repr((rows, more)).encode()).hexdigest()
    if mark not in _fitted:
        model = train(rows)
        if more:
            model = train(rows + agreeing(model, more))
        while len(_fitted) >= 4:
            _fitted.pop(next(iter(_fitted)))
        _fitted[mark] = model
    return _fitted[mark]


def fit(lang_samples: DataFrame, labelled: DataFrame | None = None, per_stratum: int = PER_STRATUM) -> Model:
    """Model from the clean table (lang_code, sample_text), of which no more than MAX_TRAINING_TEXTS rows are used.

    ``labelled`` (lang_code, text, stratum) adds everyday wording: of each language and stratum the ``per_stratum`` rows
    of the least hash, as far as a model of the clean table agrees with their labels.
    """
    rows = lang_samples.select("lang_code", "sample_text").dropna().orderBy(F.xxhash64("sample_text"), "lang_code").limit(MAX_TRAINING_TEXTS).collect()
    clean_rows = [(r.lang_code, r.sample_text) for r in rows]
    if labelled is None:
        return _trained(clean_rows, [])
    classes = sorted({lang for lang, _ in clean_rows})
    w = W.partitionBy("lang_code", "stratum").orderBy("h", "text")
    x = labelled.filter(F.col("lang_code").isin(classes) & (F.col("text") != "")).select("lang_code", "stratum", "text", F.xxhash64("text").alias("h"))
    # each task keeps its own least rows before the shuffle
    sample = x.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= per_stratum).select("lang_code", "text").collect()
    return _trained(clean_rows, sorted((r.lang_code, r.text) for r in sample))


def _labeller(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            texts = b.column(1).to_pylist()
            for k, segs in enumerate(segments(model, [None if t is None or is_filler(t) else t for t in texts])):
                rows += [(k, n + 1, lang, conf, count, len(segs)) for n, (lang, conf, count) in enumerate(segs)]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(cols[0], pa.int64())), b.column(2).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.int32())],
                ["id", "label", "seg_no", "lang_code", "confidence", "sentences", "segments"],
            )

    return run


def label_segments(model: Model, rows: DataFrame, key: str, text: str, label: Column) -> DataFrame:
    """One row per segment of every row with words: id, label, seg_no (from 1), lang_code, confidence, sentences, segments.

    A map over the rows: no shuffle, whole texts, repeated rows each on their own. ``label`` must hold a code of the
    model or null. Texts that are null, blank, fillers or without words give no row.
    """
    ship(rows.sparkSession)
    x = rows.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"), label.alias("label"))
    return x.mapInArrow(_labeller(model), "id long, label string, seg_no int, lang_code string, confidence double, sentences int, segments int")


def label_cases(labelled: DataFrame) -> DataFrame:
    """The segments of rows whose label is missing, names none of the row's languages, or that hold several languages."""
    wrong = F.col("label").isNull() | (F.col("segments") > 1) | (F.col("label") != F.col("lang_code"))
    return labelled.filter(wrong)
