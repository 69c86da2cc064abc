"""Problem 10: abusive, hateful or sexual texts, by a subsequence string-kernel support vector machine.

The kernel counts the subsequences of four to six letters that two texts share, each occurrence weighted by a decay
per letter of its span (at most six to eight), so inserted, masked and left-out characters cost little. Nystrom landmarks map a
text to its kernel values against some labelled sentences; a linear machine with squared hinge loss is trained there.
As the kernel is an inner product of sparse counts, machine and landmarks fold into one table of weights per
subsequence (hashed to 2^21 places). The sentences of a batch of texts are scored in one pass: weights of their letters
are summed up, and every sentence or window of words within one is a difference of two sums. Texts are scored whole, at
every position; a sentence that a worker has met before is looked up.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pregonero.llm.abuse_examples import GROUPS, INSULTS, labelled
from pregonero.session import ship_package

#: Letters of a subsequence -> (longest span, share).
LENGTHS = {4: (6, 0.5), 5: (7, 1.0), 6: (8, 1.0)}
DECAY = 0.75
ALPHABET = " abcdefghijklmnopqrstuvwxyz0*."
A = len(ALPHABET)
TABLE = 1 << 21
#: Words per window within a sentence; all positions are tried. Sentences of at most the longest are tried whole.
WINDOWS = (6, 10, 14)
LANDMARKS, COST, ROUNDS, UNKNOWN = 1400, 20.0, 4, 6000
#: Least score of an abusive text: the least one (in steps of 0.05) with a precision of 0.95 on sentences of held-out patterns.
ACCEPT = -0.35
#: Labelled rows used at most, and windows of neutral ones (the table has fewer of both): they bound the time and memory of
#: fitting, which takes about four bytes times windows times landmarks on the driver.
MAX_EXAMPLES, MAX_WINDOWS = 20_000, 40_000
#: Sentences whose scores a Python worker keeps.
KNOWN = 200_000
# Letters of other scripts that look like Latin ones, and signs used for letters.
LOOKALIKES = str.maketrans("аеорсхуіјѕһԁԛԝвнкмтгпАВЕКМНОРСТХУІЈЅαβεικνορτυχωΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcxyijshdqwbhkmtrnABEKMHOPCTXYIJSabeiknoptuxwABEZHIKMNOPTYX")
SIGNS = str.maketrans("01345678@$!|€", "oieasgtbasiie")
# Units and marks that stand between the digits of a figure.
UNIT_LETTERS = ["h", "m", "s", "x", "min", "km", "kg", "ha", "a", "o", "e", "r"]
_ZERO_WIDTH = re.compile("[​-‏⁠-⁤﻿­͏]")
_OTHER_SCRIPT = re.compile("[" + "".join(map(chr, LOOKALIKES)) + "]")
_MARKS = re.compile("[\u0300-\u036f]+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][\s.\-_*·•,/]{1,2}){2,}[^\W_](?![^\W_])")
_LONG = re.compile(r"(.)\1{2,}")
#: A word with signs or digits among its letters; it starts and ends with none of ! and |.
_SIGNED = re.compile(r"(?<![\w@$€*#])(?=[\w@$!|€*#]*[a-z])(?=[\w@$!|€*#]*[0-9@$!|€])[\w@$€*#](?:[\w@$!|€*#]*[\w@$€*#])?")


def _join(m: re.Match) -> str:
    return re.sub(r"[\s.\-_*·•,/]+", "", m.group())


def _unsign(m: re.Match) -> str:
    word = m.group()
    letters = sum(c.isalpha() or c in "@$!|€*#" for c in word)
    # few letters, as in 17h15 or 10m: a figure, unless one that is no unit stands between digits
    likely = (letters >= 3 and letters >= 0.4 * len(word)) or (letters >= 2 and word[0].isalpha() and len(word) >= 4 and 2 * letters >= len(word))
    likely = likely or any(x not in UNIT_LETTERS for x in re.findall(r"(?<=\d)[^\W\d_]+(?=\d)", word))
    return word.translate(SIGNS) if likely else word


def normalise(text: str) -> str:
    """Lower-case Latin letters, spaces, 0 for a number and * for a masked letter. Undoes lookalike letters, signs for
    letters, zero-width characters, letters written apart and repeated letters."""
    t = text
    if not t.isascii():
        t = _ZERO_WIDTH.sub("", t)
        t = t.translate(LOOKALIKES) if _OTHER_SCRIPT.search(t) else t
        t = _MARKS.sub("", unicodedata.normalize("NFKD", t))
        if rest := {ord(c): None for c in set(t) if unicodedata.combining(c)}:
            t = t.translate(rest)
    t = t.lower()
    t = _SPACED.sub(_join, t)
    t = _SIGNED.sub(_unsign, t)
    t = _LONG.sub(r"\1", t)
    t = re.sub(r"\d+(?:[.,:/\-]\d+)*", "0", t)
    t = re.sub(r"[*#]+", "*", t)
    t = re.sub(r"(?<![a-z])\*|\*(?![a-z])", " ", t)
    t = re.sub(r"[.!?;\n]+(?=\s|$)", ".", t)
    t = re.sub(r"[^a-z0*.]+", " ", t)
    return re.sub(r" *\.[. ]*", ".", t).strip(" .")


OFFSETS = [((0, *o), share * DECAY ** o[-1], n) for n, (span, share) in LENGTHS.items() for o in combinations(range(1, span), n - 1)]
_UNIT = float(np.sqrt(sum(w * w for _, w, _ in OFFSETS)))
_CODE = np.zeros(256, dtype=np.uint32)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i


def _codes(sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters of all sentences, each between two full stops, one after the other; where each begins and the last ends)."""
    c = np.frombuffer("".join(f".{s}." for s in sentences).encode("ascii"), dtype=np.uint8)
    return c, np.concatenate([[0], np.cumsum([len(s) + 2 for s in sentences])]).astype(np.int64)


def _subsequences(c: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """(hashed subsequence at each start, weight) per choice of offsets; TABLE where it would leave its sentence."""
    n = len(c)
    p = np.concatenate([_CODE[c], np.zeros(9, dtype=np.uint32)])
    at = [p[o : o + n] for o in range(9)]
    # none starts at the closing stop or runs over it: it may only start at the opening one and end at the closing one
    stops = np.concatenate([[0], np.cumsum(p == A - 1)])
    closing = np.zeros(n, dtype=bool)
    closing[ends[1:] - 1] = True
    over = {last: (stops[last : last + n] - stops[1 : n + 1] > 0) | closing for last in {o[-1] for o, _, _ in OFFSETS}}
    heads: list[np.ndarray] = [at[0]]  # the code of each beginning of the offsets before, which the next ones share
    before: tuple = (0,)
    for offsets, w, length in OFFSETS:
        same = next((i for i, (x, y) in enumerate(zip(before, offsets)) if x != y), min(len(before), len(offsets)))
        del heads[same:]
        for o in offsets[same:]:
            heads.append(heads[-1] * np.uint32(A) + at[o])
        before, code = offsets, heads[-1]
        yield np.where(over[offsets[-1]], np.uint32(TABLE), ((code + np.uint32(length * 7919)) * np.uint32(0x9E3779B1)) >> np.uint32(11)), w


def _windows(c: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sentence, start, end) of all windows, in the order of the sentences: every position of each size, and whole
    sentences of at most the longest size."""
    gaps = np.flatnonzero((c == 32) | (c == 46))
    of = np.searchsorted(ends, gaps, "right") - 1
    for size in WINDOWS:
        ok = of[size:] == of[:-size]
        yield of[:-size][ok], gaps[:-size][ok], gaps[size:][ok] + 1
    words_ = np.bincount(of, minlength=len(ends) - 1) - 1
    short = np.flatnonzero((words_ <= WINDOWS[-1]) & (np.diff(ends) > 2))
    yield short, ends[short], ends[short + 1]


def _chunks(sentences: list[str], letters: int = 1 << 15) -> Iterator[slice]:
    """Slices of about as many letters each: the arrays of one stay in the cache."""
    begin, n = 0, 0
    for i, s in enumerate(sentences):
        n += len(s) + 2
        if n >= letters:
            yield slice(begin, i + 1)
            begin, n = i + 1, 0
    if begin < len(sentences):
        yield slice(begin, len(sentences))


def sentences_of(normal: str) -> list[str]:
    return [s for s in normal.split(".") if s]


class Filter:
    """Weights per subsequence and bias."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias
        self.known: dict[str, float] = {}  # sentence -> score

    def best_windows(self, sentences: list[str]) -> tuple[np.ndarray, list[str]]:
        """Score and letters of the highest window of each sentence; sentences are scored by themselves, so equal ones
        score alike wherever they stand."""
        score, part = np.full(len(sentences), -9.0), [""] * len(sentences)
        for cut in _chunks(sentences):
            c, ends = _codes(sentences[cut])
            per = np.zeros(len(c), dtype=np.float32)
            for codes, w in _subsequences(c, ends):
                per += np.float32(w / _UNIT) * self.table[codes]  # place TABLE stays 0
            sums = np.concatenate([[0.0], np.cumsum(per, dtype=np.float64)])
            got, lo, hi = np.full(len(ends) - 1, -9.0), np.zeros(len(ends) - 1, dtype=np.int64), np.zeros(len(ends) - 1, dtype=np.int64)
            for of, s, e in _windows(c, ends):
                if len(of):
                    v = (sums[e] - sums[s]) / np.sqrt(e - s) + self.bias
                    first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                    most = np.repeat(np.maximum.reduceat(v, first), np.diff(np.append(first, len(v))))
                    top = np.flatnonzero(v == most)
                    top = top[np.append(True, of[top][1:] != of[top][:-1])]
                    top = top[v[top] > got[of[top]]]
                    got[of[top]], lo[of[top]], hi[of[top]] = v[top], s[top], e[top]
            score[cut] = got
            text = c.tobytes().decode("ascii")
            part[cut] = [text[a:b].strip(" .") for a, b in zip(lo, hi)]
        return score, part

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Score of each text: that of its highest sentence, -9 without any. Sentences met before are looked up; at
        most KNOWN are kept."""
        split = [sentences_of(normalise(t)) if t else [] for t in texts]
        new = sorted({s for x in split for s in x if s not in self.known})
        fresh = dict(zip(new, self.best_windows(new)[0].tolist()))
        out = np.array([max((fresh[s] if s in fresh else self.known[s] for s in x), default=-9.0) for x in split], dtype=np.float64)
        if len(self.known) + len(fresh) > KNOWN:
            self.known.clear()
        self.known.update(fresh if len(fresh) <= KNOWN else {})
        return out

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])

    def save(self, path: str) -> None:
        """Keep a fitted filter, so that other jobs needn't fit it again."""
        at = np.flatnonzero(self.table)
        np.savez_compressed(path, at=at, w=self.table[at], bias=self.bias)

    @staticmethod
    def load(path: str) -> Filter:
        with np.load(path) as f:
            table = np.zeros(TABLE + 1, dtype=np.float32)
            table[f["at"]] = f["w"]
            return Filter(table, float(f["bias"]))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 300) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps on the active set; rows are taken in slices."""
    dim, cuts = x.shape[1] + 1, [slice(i, i + 4096) for i in range(0, len(x), 4096)]
    wide = lambda c: np.hstack([x[c].astype(np.float64), np.ones((len(y[c]), 1))])
    w = np.zeros(dim)
    reg = np.eye(dim)
    reg[-1, -1] = 1e-6
    for step in range(steps):
        left, right = reg.copy(), np.zeros(dim)
        for c in cuts:
            xc = wide(c)
            xa = xc[(active := y[c] * (xc @ w) < 1)]
            wa = weight[c][active] * COST
            left += xa.T @ (xa * wa[:, None])
            right += xa.T @ (y[c][active] * wa)
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-7:
            break
        w = 0.5 * w + 0.5 * new if step > 20 else new
    return w[:-1], float(w[-1])


_NAME = re.compile(r"\b[A-ZÀ-Ý][\w'-]+(?:\s+(?:d[aoe]s?\s+)?[A-ZÀ-Ý][\w'-]+)+")
_SYLLABLES = [c + v for c in "b c d f g j l m n p q r s t v x z br tr pr gr dr ch lh nh qu gu".split() for v in "a e i o u".split()]


def unknown_texts(rng: np.random.Generator, count: int) -> list[str]:
    """Neutral by construction: words of random syllables, with the particles and endings of the languages. They teach the machine that
    letters it doesn't know are no evidence, as are names, which look like these."""
    ends = ["", "", "s", "r", "l", "m", "do", "cao", "mento", "dade", "al", "ardo", "ancia", "inho", "ing", "ed", "cion"]
    small = ["de", "da", "do", "em", "na", "no", "e", "o", "a", "que", "para", "com", "um", "uma", "the", "of", "and", "el", "la", "los", "se", "por", "os", "as", "ao", "y", "in", "to", "0", "0"]
    out = []
    for _ in range(count):
        n = int(rng.integers(4, 13))
        word = lambda: "".join(rng.choice(_SYLLABLES, int(rng.integers(1, 4)))) + str(rng.choice(ends))
        out.append(" ".join(str(rng.choice(small)) if rng.random() < 0.4 else word() for _ in range(n)))
    return out


def _mask(text: str, rng: np.random.Generator) -> str:
    """The text with one inner letter of a longer word masked, as writers do."""
    words_ = text.split(" ")
    long = [i for i, w in enumerate(words_) if len(w) >= 4]
    if long:
        i = long[int(rng.integers(len(long)))]
        k = int(rng.integers(1, len(words_[i]) - 1))
        words_[i] = words_[i][:k] + "*" + words_[i][k + 1 :]
    return " ".join(words_)


class _Landmarks:
    """The kernel against some sentences, as a sparse matrix in the order of the subsequences."""

    def __init__(self, marks: list[str]):
        self.n = len(marks)
        keys, weights = [], []
        for cut in _chunks(marks):
            c, ends = _codes(marks[cut])
            of = np.repeat(np.arange(cut.start, cut.start + len(ends) - 1), np.diff(ends))
            for codes, w in _subsequences(c, ends):
                ok = codes < TABLE
                keys.append(codes[ok].astype(np.int64) * self.n + of[ok])
                weights.append(np.full(ok.sum(), w))
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        size = _UNIT * np.sqrt(np.array([len(m) + 2 for m in marks]))
        self.code, self.mark = key // self.n, (key % self.n).astype(np.int32)
        self.weight = (np.bincount(inverse, np.concatenate(weights)) / size[self.mark]).astype(np.float32)
        self.first = np.searchsorted(self.code, np.arange(TABLE + 2)).astype(np.int64)

    def kernel(self, sentences: list[str]) -> np.ndarray:
        """sentences x landmarks."""
        out = np.zeros((len(sentences), self.n), dtype=np.float32)
        for cut in _chunks(sentences, 1 << 12):
            c, ends = _codes(sentences[cut])
            m = len(ends) - 1
            of = np.repeat(np.arange(m), np.diff(ends))
            got = np.zeros(m * self.n)
            for codes, w in _subsequences(c, ends):
                lo, n = self.first[codes], self.first[codes + np.uint32(1)] - self.first[codes]
                some = (n > 0) & (codes < TABLE)
                n, lo, row = n[some], lo[some], of[some]
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                got += np.bincount(np.repeat(row, n) * self.n + self.mark[at], self.weight[at] * w, m * self.n)
            out[cut] = got.reshape(m, self.n) / (_UNIT * np.sqrt(np.diff(ends)))[:, None]
        return out

    def table(self, of_mark: np.ndarray) -> np.ndarray:
        """The weight of every subsequence in the combination of the landmarks."""
        return np.bincount(self.code, self.weight * of_mark[self.mark], TABLE + 1).astype(np.float32)


def train(examples: list[tuple[str, int]], seed: int = 7) -> Filter:
    """Fit on labelled texts. After each round the highest window of every text joins the training set: of a neutral
    text no window may score, of an abusive one the highest should."""
    rng = np.random.default_rng(seed)
    texts = [(normalise(_NAME.sub("Nome", t) if l else t), l) for t, l in examples]
    texts = sorted({(t, l) for t, l in texts if t})
    pos = sorted({t.replace(".", " ") for t, l in texts if l})
    neg = sorted({s for t, l in texts if not l for s in sentences_of(t)})
    pick = lambda xs, k: [xs[i] for i in sorted(rng.permutation(len(xs))[:k])]
    chosen = pick(pos, LANDMARKS * 7 // 10) + pick(neg, LANDMARKS * 3 // 10)
    marks = _Landmarks(chosen)
    vals, vecs = np.linalg.eigh(marks.kernel(chosen).astype(np.float64))
    keep = vals > 1e-6 * vals.max()
    root = vecs[:, keep] / np.sqrt(vals[keep])  # Nystrom map: kernel values @ root

    # kind 0: abusive; 1: labelled neutral; 2: windows of it and unknown text
    bag: dict[str, int] = dict.fromkeys(neg, 1) | dict.fromkeys(pos, 0)
    bag |= {m: 0 for m in (_mask(t, rng) for t in pos) if m not in bag}
    bag |= {x: 2 for t in unknown_texts(rng, UNKNOWN) for x in sentences_of(normalise(t)) if x not in bag}
    c, ends = _codes(neg)
    text = c.tobytes().decode("ascii")
    parts = {w for _, lo, hi in _windows(c, ends) for w in (text[a:b].strip(" .") for a, b in zip(lo, hi)) if w and w not in bag}
    bag |= dict.fromkeys(pick(sorted(parts), MAX_WINDOWS), 2)  # no window of a neutral text may score
    rows, x = list(bag), np.zeros((0, int(keep.sum())), dtype=np.float32)
    for _ in range(ROUNDS):
        new = rows[len(x) :]
        x = np.vstack([x, *((marks.kernel(new[i : i + 4096]) @ root).astype(np.float32) for i in range(0, len(new), 4096))])
        kind = np.array([bag[t] for t in rows])
        weight = (len(kind) * np.array([0.3, 0.4, 0.3]) / np.maximum(1, np.bincount(kind, minlength=3)))[kind]
        v, b = _svm(x, np.where(kind == 0, 1.0, -1.0), weight)
        model = Filter(marks.table(root @ v), b)
        score, best = model.best_windows(whole := sorted({s for t, _ in texts for s in sentences_of(t)}))
        top = dict(zip(whole, zip(score, best)))
        for t, label in texts:
            part = max((top[s] for s in sentences_of(t)), default=(0.0, ""))[1]
            if part and part not in bag:
                bag[part] = 0 if label else 1 if part in neg else 2
                rows.append(part)
    return model


def _pattern(sentence: str) -> str:
    """What sentences of one kind share: the first words, with insults, groups and names left out."""
    filled = {w for x in INSULTS + GROUPS for w in normalise(x).split()}
    return " ".join([w for w in sentence.split() if w not in filled and w.rstrip("s") not in filled and w != "nome"][:3])


def held_out(examples: list[tuple[str, int]], folds: int = 5, seed: int = 7) -> list[tuple[float, int, str]]:
    """(score, label, sentence) of every distinct labelled sentence by a filter that was fitted without the sentences
    of its pattern. ACCEPT is the least threshold in steps of 0.05 with a precision of 0.95 on these; no document takes part."""
    rows = sorted({(s, label) for t, label in examples for s in sentences_of(normalise(_NAME.sub("Nome", t)))})
    groups = sorted({_pattern(s) for s, _ in rows})
    fold = dict(zip((groups[i] for i in np.random.default_rng(seed).permutation(len(groups))), (i % folds for i in range(len(groups)))))
    out = []
    for k in range(folds):
        model = train([(s, label) for s, label in rows if fold[_pattern(s)] != k])
        rest = [(s, label) for s, label in rows if fold[_pattern(s)] == k]
        out += [(float(v), label, s) for v, (s, label) in zip(model.best_windows([s for s, _ in rest])[0], rest)]
    return out


def rates_at(scored: list[tuple[float, int, str]], threshold: float) -> tuple[float, float]:
    """Precision and recall of the scores at a threshold."""
    hit = [label for v, label, _ in scored if v >= threshold]
    return sum(hit) / max(1, len(hit)), sum(hit) / max(1, sum(label for _, label, _ in scored))


def fit(reviewed: DataFrame) -> Filter:
    """Trained on the table of hand-judged texts (all of it up to MAX_EXAMPLES rows) and the sentences kept here."""
    rows = reviewed.where(F.col("text").isNotNull() & F.col("abusive").isNotNull()).select("text", "abusive").orderBy("example_id").limit(MAX_EXAMPLES).collect()
    return train([(r.text, int(r.abusive)) for r in rows] + labelled())


def score_documents(documents: DataFrame, model: Filter, text: str = "text", out: str = "abuse_score") -> DataFrame:
    """documents with the score of their highest window; at least ACCEPT means abusive. Null and empty texts score -9. The
    weights go to the workers once, as a broadcast of fixed size (the table of all subsequences)."""
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast((np.flatnonzero(model.table).astype(np.int32), model.table[model.table != 0], model.bias))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w, bias = shared.value
        table = np.zeros(TABLE + 1, dtype=np.float32)
        table[at] = w
        local = Filter(table, bias)
        for texts in batches:
            yield pd.Series(local.scores([t if isinstance(t, str) else None for t in texts]), dtype="float64")

    return documents.withColumn(out, scored(F.col(text)))
