"""Score of abusive, hateful or sexual language by a factorization machine over hashed terms.

A text is divided into sentences and these into windows of WINDOW words at steps of STEP. Spellings are undone first
(look-alike letters of other alphabets, digits and signs for letters, invisible characters, spaced or repeated letters,
masked letters). A window's terms are its words, the beginnings of long words and, in Chinese, characters and pairs of
adjacent characters; there are no terms of word pairs. The machine adds to each term's weight the inner products of the
terms' factors over all pairs of the window, so that an insult weighs more beside a person or a group than beside a
tripod, which weights alone cannot express. A document's score is its highest window's.

The model is trained on raters' judgements of whole documents. What a flag is worth is estimated from the judgements
alone, by a mixture of two binomials (how often raters flag a document that deserves it, and one that does not). Which
windows are to blame isn't known, so training is an expectation-maximisation: a document counts by its highest window,
each window by its own probability given the document's judgements, and machines are fitted on these. Probabilities of a
document's windows come from a machine fitted without it. The score from which documents are flagged is the one at
which a flag is deserved with the chance CHANCE, by those held-out scores. A few general sentences are always part of the training, so that the
model is defined without any judgement.

Texts are cleaned, divided and coded by Arrow kernels in whole batches; a window's score is a difference of running sums,
so the time is linear in the number of words, however long a text is.

Cases: null, empty and blank texts have score 0.0; long texts are read whole; null judgements don't count; repeated
judgements of one rater count once; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Judged documents the model is fitted on at most, in the order of a hash of their id, and their characters together.
LABELLED_DOCUMENTS, LABELLED_CHARACTERS = 20_000, 32_000_000
#: Hash bits, factors of a term in a machine, machines, words of a window and its step.
BITS, FACTORS, MACHINES, WINDOW, STEP = 18, 4, 3, 16, 4
#: Passes over the windows in a fit, rounds of expectation and fitting, folds, and the fit's rate, decay, least and
#: greatest batch (a hundredth of the windows between them) and first bias.
EPOCHS, ROUNDS, FOLDS, RATE, DECAY, BATCH, BIAS = 3, 4, 3, 0.25, 1e-3, (64, 512), -2.0
#: Chance of deserving a flag from which a document is flagged.
CHANCE = 2 / 3
#: Characters of the texts that are read at once, and different words a worker remembers.
SLICE, REMEMBERED = 4_000_000, 1_000_000

#: Letters of other alphabets that look like Latin ones, and digits and signs written for letters.
LOOKALIKES = dict(zip("авеікмнорстухѕјԁɡьαβεηικμνορτυχγ", "abeikmhopctyxsjdgbabehikmvoptuxy"))
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "$": "s", "@": "a", "!": "i", "€": "e", "£": "l"}
MASK = "*_#·•"
_TERM = (1 << BITS) - 1
_APART = r"[,;:()\[\]{}<>|/\\\"“”„«»‘`~^=+—–、，；：（）「」『』《》【】]"
_ENDS = ".!?。！？"

#: General sentences that are part of every training (1: abusive, hateful or sexual, 0: not).
SEEDS: list[tuple[int, str]] = [
    (1, "You are an idiot."), (1, "Shut up, you stupid moron."), (1, "You worthless piece of shit."), (1, "Fuck you, asshole."),
    (1, "Nobody likes you, you pathetic loser."), (1, "I will kill you."), (1, "I will break your legs."), (1, "Go and die."),
    (1, "Those people are animals and should be thrown out."), (1, "Women are too stupid to use a camera."), (1, "They are vermin, get rid of them all."),
    (1, "Immigrants are parasites."), (1, "She sucks his cock."), (1, "They fuck naked on the bed."), (1, "Send me naked pictures."), (1, "I want to see your tits."),
    (1, "Eres un idiota."), (1, "Vete a la mierda, imbécil."), (1, "Te voy a matar."), (1, "Hijo de puta."),
    (1, "Du bist ein Idiot."), (1, "Halt die Fresse, du Arschloch."), (1, "Ich bringe dich um."), (1, "Du dumme Sau."),
    (1, "你是个白痴。"), (1, "滚开，傻逼。"), (1, "我要杀了你。"), (1, "他们都是垃圾。"),
    (0, "I am such an idiot, I forgot the key."), (0, "Damn, the battery is empty."), (0, "This tripod is shit."), (0, "What a stupid mistake of mine."),
    (0, "Kill the process and start it again."), (0, "The rat in the lab was healthy."), (0, "The nurse checks the breast for cancer."), (0, "Beat the eggs and whip the cream."),
    (0, "The rooster is also called a cock."), (0, "The rules forbid insults and hateful comments."), (0, "Sex education is taught at school."), (0, "The statue is nude."),
    (0, "Immigrants live in the town."), (0, "Women use the camera."), (0, "The shooting of the film went well."), (0, "The parasite lives in fish."),
    (0, "Garbage is collected on Monday."), (0, "The light is nice."), (0, "Please look at this clip."), (0, "You are right, thank you."),
    (0, "La cámara está en la mesa."), (0, "Gracias por compartir."), (0, "Die Kamera steht auf dem Tisch."), (0, "Danke für das Teilen."),
    (0, "摄像机在桌子上。"), (0, "请重启进程。"),
]


class Terms:
    """Hashed terms of texts; remembers the words it has seen."""

    def __init__(self, vocabulary: Iterable[str] = ()):
        import regex

        self.spaced = re.compile(r"(?<!\w)(?:[^\W\d_][ .·_-]){2,}[^\W\d_](?!\w)")
        self.runs = regex.compile(r"(\p{L})\1{2,}")
        self.edge = regex.compile(r"^[^\p{L}\p{N}$@*#]+|[^\p{L}\p{N}$*#]+$")
        self.known: dict[int, list[str]] = defaultdict(list)
        for w in sorted(set(vocabulary)):
            self.known[len(w)].append(w)
        self.seen: dict[str, tuple[int, int, bool, bool]] = {}

    def plain(self, word: str) -> str:
        """The word that a spelling stands for."""
        if any("a" <= c <= "z" for c in word) and not word.isascii():
            word = "".join(LOOKALIKES.get(c, c) for c in word)
        elif not word.isascii() and all(c in LOOKALIKES for c in word):
            word = "".join(LOOKALIKES[c] for c in word)
        letters = sum(c.isalpha() for c in word)
        if not letters:
            return "0"
        if letters >= 2 and letters < len(word):
            word = "".join(LEET.get(c, c) for c in word)
            if any(c in MASK for c in word):
                return self._unmask(word)
            word = word.replace("-", "") if all(len(p) == 1 for p in word.split("-")) else word
        return self.runs.sub(r"\1", word)

    def _unmask(self, word: str) -> str:
        """A known word of the same length that agrees in all letters shown."""
        short = self.runs.sub(r"\1", word)
        for w in dict.fromkeys((word, short)):
            for k in self.known.get(len(w), ()):
                if all(a == b or a in MASK for a, b in zip(w, k)):
                    return k
        return short

    def describe(self, token: str) -> tuple[int, int, bool, bool]:
        """(term, term of its beginning, Han character, ends a sentence) of a token; -1 for no term."""
        import xxhash

        end = token[-1:] in _ENDS and token != ""
        if len(token) == 1 and "\u3400" <= token <= "\u9fff":
            return xxhash.xxh32_intdigest(token) & _TERM, -1, True, False
        word = self.edge.sub("", token)
        if not word:
            return -1, -1, False, end
        word = self.plain(word)
        begins = xxhash.xxh32_intdigest(word[:5] + "~") & _TERM if len(word) >= 6 and word.isalpha() else -1
        return xxhash.xxh32_intdigest(word) & _TERM, begins, False, end

    def _clean(self, texts: pa.Array, ascii: bool) -> pa.Array:
        """Lower case, without invisible characters and accents, Chinese characters and line ends apart, marks blank."""
        if ascii:
            x = pc.ascii_lower(texts)
        else:
            x = pc.utf8_normalize(pc.utf8_lower(pc.utf8_normalize(texts, "NFKC")), "NFKD")
            x = pc.replace_substring_regex(x, r"[\p{Cf}\p{Mn}]", "")
            x = pc.replace_substring_regex(x, r"([\p{Han}。！？])", r" \1 ")
            x = pc.replace_substring_regex(x, r"\p{So}", " 。 ")  # a picture ends a sentence
        far = pc.match_substring_regex(x, r"(?:^|[^\pL\pN])\pL[ .·_-]\pL[ .·_-]")
        if pc.any(far).as_py():
            fixed = [self.spaced.sub(lambda m: "".join(c for c in m.group(0) if c.isalpha()), t) for t in x.filter(far).to_pylist()]
            x = pc.replace_with_mask(x, far, pa.array(fixed, x.type))
        return pc.replace_substring_regex(pc.replace_substring(x, "\n", " 。 "), _APART, " ")

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
        """(number of each token's string, the strings, each token's text), texts in order, plain ASCII ones first."""
        texts = texts.fill_null("")
        plain, parts, owners = pc.string_is_ascii(texts), [], []
        for mask, ascii in ((plain, True), (pc.invert(plain), False)):
            words = pc.utf8_split_whitespace(self._clean(texts.filter(mask), ascii))
            parts.append(words.flatten())
            owners.append(np.repeat(np.flatnonzero(np.asarray(mask)), np.asarray(words.value_lengths())))
        coded = pa.concat_arrays(parts).dictionary_encode()
        return np.asarray(coded.indices), coded.dictionary.to_pylist(), np.concatenate(owners)

    def read(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """(row of ``table`` of each word; its two terms, -1 for none; words that end a pair of Chinese characters, and its
        term; first word, last word + 1 and text of each window)."""
        at, strings, owner = self.tokens(texts)
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        rows = []
        for s in strings:
            r = self.seen.get(s)
            if r is None:
                r = self.seen[s] = self.describe(s)
            rows.append(r)
        table = np.array(rows, dtype=np.int64).reshape(-1, 4)
        ends, named = table[:, 3] > 0, table[:, 0] >= 0
        sentence = np.cumsum(np.r_[False, (owner[1:] != owner[:-1]) | ends[at[:-1]]]) if len(at) else at
        keep = named[at]
        at, sentence, owner = at[keep], sentence[keep], owner[keep]
        none = np.empty(0, dtype=np.int64)
        if not len(at):
            return at, table[:, :2], none, none, none, none, none
        new = np.r_[True, sentence[1:] != sentence[:-1]]
        han = (table[:, 2] > 0)[at]
        second = np.flatnonzero(han[1:] & han[:-1] & ~new[1:]) + 1
        pair = ((table[at[second - 1], 0] * 0x9E3779B1 ^ table[at[second], 0] * 0x85EBCA6B) >> 5) & _TERM
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(at)]
        size = last - first
        number = np.where(size <= WINDOW, 1, -(-(size - WINDOW) // STEP) + 1)
        start = np.repeat(first, number) + STEP * (np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number))
        return at, table[:, :2], second, pair, start, np.minimum(start + WINDOW, np.repeat(last, number)), owner[start]

    def windows(self, texts: Sequence[str | None]) -> list[list[tuple[int, ...]]]:
        """Terms of the windows of each text."""
        at, table, second, pair, start, end, owner = self.read(pa.array(texts, pa.string()))
        out: list[list[tuple[int, ...]]] = [[] for _ in texts]
        rows, pairs = table[at].tolist(), dict(zip(second.tolist(), pair.tolist()))
        for a, b, o in zip(start.tolist(), end.tolist(), owner.tolist()):
            words = [x for r in rows[a:b] for x in r if x >= 0]
            # A pair whose first character lies before the window is none of its terms.
            out[o].append(tuple(sorted([*words, *(pairs[i] for i in range(a + 1, b) if i in pairs)] if pairs else words)))
        return out


class Machine:
    """Factorization machine: bias + sum of weights + sum of factor products over all pairs of terms, scaled by length."""

    def __init__(self, terms: int, factors: int = FACTORS, seed: int = 7):
        self.bias, self.weight = 0.0, np.zeros(terms)
        self.factor = np.random.default_rng(seed).normal(0, 0.05, (terms, factors)) if factors else np.zeros((terms, 0))

    def raw(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log odds, factors of each term, their sums) of rows of terms given one after the other."""
        starts = np.cumsum(sizes) - sizes
        v = self.factor[flat]
        total = np.add.reduceat(v, starts, axis=0)
        square = np.add.reduceat((v * v).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.weight[flat], starts) / np.sqrt(sizes) + 0.5 * ((total * total).sum(axis=1) - square) / sizes, v, total

    def fit(self, flat: np.ndarray, offsets: np.ndarray, use: np.ndarray, y: np.ndarray, importance: np.ndarray, seed: int) -> None:
        """AdaGrad on the logistic loss in mini-batches of the rows ``use``."""
        rng, all_sizes = np.random.default_rng(seed), np.diff(offsets)
        self.bias, batch = BIAS, int(np.clip(len(use) // 100, *BATCH))
        gw, gv, gb = np.full_like(self.weight, 1e-3), np.full_like(self.factor, 1e-3), 1.0
        for _ in range(EPOCHS):
            order = rng.permutation(len(use))
            for i in range(0, len(order), batch):
                some = order[i : i + batch]
                sizes = all_sizes[use[some]]
                starts = np.cumsum(sizes) - sizes
                terms = flat[np.repeat(offsets[use[some]] - starts, sizes) + np.arange(sizes.sum())]
                raw, v, total = self.raw(terms, sizes)
                e = (1 / (1 + np.exp(-raw)) - y[some]) * importance[some]
                own = np.repeat(np.arange(len(some)), sizes)
                uniq, at = np.unique(terms, return_inverse=True)
                dw = np.bincount(at, (e / np.sqrt(sizes))[own], len(uniq)) + DECAY * self.weight[uniq]
                gw[uniq] += dw**2
                self.weight[uniq] -= RATE * dw / np.sqrt(gw[uniq])
                if self.factor.shape[1]:
                    inner = (e / sizes)[own][:, None] * (total[own] - v)
                    by = np.argsort(at, kind="stable")
                    dv = np.add.reduceat(inner[by], np.searchsorted(at[by], np.arange(len(uniq))), axis=0) + DECAY * self.factor[uniq]
                    gv[uniq] += dv**2
                    self.factor[uniq] -= 0.5 * RATE * dv / np.sqrt(gv[uniq])
                gb += float(e.sum()) ** 2
                self.bias -= RATE * float(e.sum()) / np.sqrt(gb)


class Model:
    """Machine, vocabulary and threshold together; this is what is broadcast (about 10 MB, whatever the data)."""

    def __init__(self, machine: Machine, vocabulary: list[str], threshold: float):
        self.machine, self.vocabulary, self.threshold = machine, vocabulary, threshold
        self.terms = Terms(vocabulary)

    def __reduce__(self):
        m = self.machine
        return _restore, (m.bias, m.weight.astype(np.float32), m.factor.astype(np.float32), self.vocabulary, self.threshold)

    def scores(self, texts: Sequence[str | None] | pa.Array) -> np.ndarray:
        """Highest score of any window of each text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        size = np.asarray(pc.binary_length(texts).fill_null(0)).astype(np.int64)
        part = np.cumsum(size) // SLICE
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(texts)] if len(texts) else [0, 0]
        return np.concatenate([self._score(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])])

    def _of(self, terms: np.ndarray) -> np.ndarray:
        m, there = self.machine, terms >= 0
        v = m.factor[terms].astype(np.float64)
        return np.column_stack([np.ones(len(terms)), m.weight[terms], (v * v).sum(axis=1), v]) * there[:, None]

    def _score(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), -np.inf)
        at, table, second, pair, start, end, owner = self.terms.read(texts)
        if len(start):
            # Of each different word and pair: number of terms, weights, squared factors, factors.
            words = self._of(table[:, 0]) + self._of(table[:, 1])
            pairs = self._of(pair)
            sums = np.zeros((len(at) + 1, words.shape[1]))
            sums[1:] = words[at]
            sums[second + 1] += pairs
            before = np.zeros(len(at), dtype=np.int64)
            before[second] = 1 + np.arange(len(second))
            np.cumsum(sums, axis=0, out=sums)
            # A pair whose first character lies before the window is none of its terms.
            s = sums[end] - sums[start] - np.concatenate([np.zeros((1, words.shape[1])), pairs])[before[start]]
            raw = self.machine.bias + s[:, 1] / np.sqrt(s[:, 0]) + 0.5 * ((s[:, 3:] ** 2).sum(axis=1) - s[:, 2]) / s[:, 0]
            np.maximum.at(out, owner, raw)
        return 1 / (1 + np.exp(-out))


def _restore(bias: float, weight: np.ndarray, factor: np.ndarray, vocabulary: list[str], threshold: float) -> Model:
    machine = Machine.__new__(Machine)
    machine.bias, machine.weight, machine.factor = bias, weight, factor
    return Model(machine, vocabulary, threshold)


def rater_rates(flags: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """(share of documents that deserve a flag, how often those get one, how often others do), from votes alone.

    Expectation-maximisation of a mixture of two binomials, with a few judgements' worth of a usual rater added.
    """
    share, hit, false = 0.1, 0.9, 0.05
    for _ in range(200):
        a, b = share * hit**flags * (1 - hit) ** (n - flags), (1 - share) * false**flags * (1 - false) ** (n - flags)
        q = a / (a + b)
        share, hit, false = (q.sum() + 1) / (len(q) + 10), (flags @ q + 9) / (n @ q + 10), (flags @ (1 - q) + 0.5) / (n @ (1 - q) + 10)
    return share, hit, false


def flag_threshold(scores: np.ndarray, likely: np.ndarray, unlikely: np.ndarray) -> float:
    """The score at which a document deserves a flag with the probability CHANCE.

    The chance is a logistic function of the score's log odds, fitted to the judgements by expectation-maximisation.
    """
    s = np.clip(scores, 1e-6, 1 - 1e-6)
    x = np.column_stack([np.log(s / (1 - s)), np.ones(len(s))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        c = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        q = c * likely / (c * likely + (1 - c) * unlikely)
        for _ in range(3):
            c = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            # A little of the identity keeps the fit defined where the scores divide the documents completely.
            w = w + np.linalg.solve((x * (c * (1 - c))[:, None]).T @ x + 0.1 * np.eye(2), x.T @ (q - c) - 0.1 * (w - np.array([1.0, 0.0])))
    return float(1 / (1 + np.exp(np.clip((w[1] - np.log(CHANCE / (1 - CHANCE))) / w[0], -30, 30)))) if w[0] > 0 else 0.5


def _vocabulary(texts: pa.Array, flagged: np.ndarray) -> list[str]:
    """Whole words that flagged documents have more than twice as often as documents on average."""
    terms = Terms()
    at, strings, owner = terms.tokens(texts)
    words = [terms.plain(w) if (w := terms.edge.sub("", s)) else "" for s in strings]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    code = np.array([number[w] for w in words], dtype=np.int64)[at]
    pair = np.unique(owner.astype(np.int64) * (len(number) + 1) + code)
    doc, word = pair // (len(number) + 1), pair % (len(number) + 1)
    seen, bad = np.bincount(word, minlength=len(number)), np.bincount(word, flagged[doc], len(number))
    rate = flagged.mean()
    return sorted(w for w, i in number.items() if len(w) >= 3 and w.isalpha() and bad[i] > 2 * rate * seen[i])


def train(documents: Sequence[tuple[str | None, float, float]], factors: int = FACTORS, seeds: Sequence[tuple[int, str]] = tuple(SEEDS)) -> Model:
    """Model from (text, flags, judgements) of judged documents; a general sentence counts as one judged alike by three."""
    docs = [*((t, f, n) for t, f, n in documents if t and n), *((t, 3.0 * y, 3.0) for y, t in seeds)]
    if not docs:
        raise ValueError("neither judgements nor general sentences to train on")
    flags, n = np.array([d[1] for d in docs]), np.array([d[2] for d in docs])
    share, hit, false = rater_rates(flags, n)
    likely, unlikely = hit**flags * (1 - hit) ** (n - flags), false**flags * (1 - false) ** (n - flags)
    votes = share * likely / (share * likely + (1 - share) * unlikely)
    vocabulary = _vocabulary(pa.array([d[0] for d in docs], pa.string()), votes)

    # Different windows as rows of terms; documents as rows of windows.
    index: dict[tuple[int, ...], int] = {}
    members = [np.array(sorted({index.setdefault(w, len(index)) for w in ws}), dtype=np.int64) for ws in Terms(vocabulary).windows([d[0] for d in docs])]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in index])])
    used, flat = np.unique(np.concatenate([np.array(w, dtype=np.int64) for w in index]), return_inverse=True)
    window = np.concatenate(members)
    doc = np.repeat(np.arange(len(docs)), [len(m) for m in members])
    fold = np.arange(len(docs)) % FOLDS

    def fitted(blame: np.ndarray, of: np.ndarray, seed: int = 7) -> Machine:
        count = np.bincount(window[of], minlength=len(index))
        use = np.flatnonzero(count)
        machine = Machine(len(used), factors, seed)
        machine.fit(flat, offsets, use, np.bincount(window[of], blame[of], len(index))[use] / count[use], np.minimum(count[use], 10.0), seed)
        return machine

    # Before anything is known of windows, each is as suspect as the documents it occurs in are on average.
    p = (np.bincount(window, votes[doc], len(index)) / np.bincount(window, minlength=len(index)))[window]
    for _ in range(ROUNDS - 1):
        p = np.clip(p, 1e-5, 1 - 1e-5)
        top = np.zeros(len(docs))
        np.maximum.at(top, doc, p)
        blame = np.minimum(1.0, p * likely[doc] / (top * likely + (1 - top) * unlikely)[doc])
        for k in range(FOLDS):
            machine = fitted(blame, fold[doc] != k) if (fold != k).any() else fitted(blame, fold[doc] == k)
            raw = machine.raw(flat, np.diff(offsets))[0]
            p = np.where(fold[doc] == k, (1 / (1 + np.exp(-raw)))[window], p)
    top = np.zeros(len(docs))
    np.maximum.at(top, doc, p)
    threshold = flag_threshold(top, likely, unlikely)
    # Combinations that no document has shown come out by chance; the mean of several machines has less of it, and is
    # again a factorization machine, whose factors are those of all.
    several = [fitted(blame, np.ones(len(doc), dtype=bool), seed) for seed in range(MACHINES)]
    full = Machine.__new__(Machine)
    full.bias, full.weight, full.factor = float(np.mean([m.bias for m in several])), np.zeros(1 << BITS), np.zeros((1 << BITS, factors * MACHINES))
    full.weight[used] = np.mean([m.weight for m in several], axis=0)
    full.factor[used] = np.concatenate([m.factor for m in several], axis=1) / np.sqrt(MACHINES)
    return Model(full, vocabulary, threshold)


def judged_documents(documents: DataFrame, judgements: DataFrame, limit: int = LABELLED_DOCUMENTS, characters: int = LABELLED_CHARACTERS) -> list[tuple[str | None, float, float]]:
    """(text, flags, judgements) of judged documents in the order of a hash of the id, at most ``limit`` of them and as many
    as have ``characters`` together."""
    once = judgements.where("flagged is not null and doc_id is not null").groupBy("doc_id", "rater").agg(F.max(F.col("flagged").cast("int")).alias("f"))
    votes = once.groupBy("doc_id").agg(F.sum("f").alias("flags"), F.count(F.lit(1)).alias("n"))
    votes = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()
    spark = documents.sparkSession
    first = spark.createDataFrame([(r["doc_id"], i, float(r["flags"]), float(r["n"])) for i, r in enumerate(votes)], "doc_id bigint, place int, flags double, n double")
    rows = documents.select("doc_id", "text").join(F.broadcast(first), "doc_id")  # at most ``limit`` rows
    sizes = sorted(rows.select("place", "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("size")).collect())
    upto, within = 0, []
    for r in sizes:
        upto += r["size"]
        if upto > characters:
            break
        within.append(r["place"])
    last = within[-1] if within else -1
    got = rows.where(F.col("place") <= last).collect()
    return [(r["text"], r["flags"], r["n"]) for r in sorted(got, key=lambda r: (r["place"], r["doc_id"]))]


def score(spark: SparkSession, text: Column, model: Model) -> Column:
    """Score of each text between 0 and 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            yield pa.array(m.scores(batch), type=pa.float64())

    return run(text)


def score_documents(documents: DataFrame, judgements: DataFrame) -> DataFrame:
    """``documents`` with ``score`` and ``abusive``, which replace columns of these names."""
    spark = documents.sparkSession
    model = train(judged_documents(documents, judgements))
    return documents.withColumn("score", score(spark, F.col("text"), model)).withColumn("abusive", F.col("score") >= model.threshold)
