"""Toxicity of texts whose words may be disguised: a noisy channel, its decoder and a word model.

A disguised word is a chain of characters some of which stand for others (digits and signs for
letters), are there more often than meant, or were put between letters. A character language model,
counted over all texts, and the costs of these disguises weigh every reading of the chain; a Viterbi
pass over the lattice of readings finds the best. The restored words are scored.

Only words with a weight can change a score, and a reading never changes the skeleton of a chain:
its letters in classes that disguises mix up, without signs between them and without repetitions. So
of all chains, however they are cut by blanks, those whose skeleton is that of a weighted word are
found by rolling hashes, and only these are decoded.
"""

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from goldquarry.llm.common import small_batches, stage
from goldquarry.llm.kernels import U64, Rolling, cached, mix, text_slices

# Signs and the letters they stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "!": "il", "|": "il", "2": "z", "3": "e", "€": "e", "4": "a", "@": "a", "5": "s", "$": "s",
    "6": "g", "9": "g", "7": "t", "+": "t", "8": "b",
}
# Costs in nats of a sign for a letter, of one more of a character and of a character between letters.
SIGN, REPEAT, BETWEEN = 1.0, 2.5, 2.5

# The language model knows the edge of a word, a to z (accents left out) and any other letter.
SYMBOLS = 28
OTHER_LETTER = 27
BACKOFF = 5.0

# Labelled documents of each class that the word model is fitted on, about.
SAMPLE_DOCS = 4000
# Different contexts in toxic documents that a word needs for a weight, and the least weight.
LEAST_CONTEXTS, LEAST_WEIGHT = 3, 1.0
PRIOR = 2.0
RIDGE = 0.01
TOXIC_FROM = 0.7


def _tables():
    """Per code point: symbol of the language model, skeleton class, whether a letter, lower case."""
    n = 0x110000
    symbol, skeleton = np.zeros(n, np.uint8), np.zeros(n, np.uint32)
    letter, lower = np.zeros(n, bool), np.arange(n, dtype=np.uint32)
    for cp in range(n):
        c = chr(cp)
        if unicodedata.category(c)[0] == "L":
            low = c.lower() if len(c.lower()) == 1 else c
            base = unicodedata.normalize("NFKD", low)[0]
            plain = "a" <= base <= "z"
            letter[cp], lower[cp] = True, ord(low)
            symbol[cp] = ord(base) - 96 if plain else OTHER_LETTER
            skeleton[cp] = ord(base if plain else low)
    for sign, letters in STANDS_FOR.items():
        skeleton[ord(sign)] = min(map(ord, letters))
    # Letters that one sign stands for are one class.
    for letters in STANDS_FOR.values():
        for c in letters[1:]:
            skeleton[skeleton == ord(c)] = ord(min(letters))
    return symbol, skeleton, letter, lower


def tables():
    return cached("toxicity tables", _tables)


def _codes(data: np.ndarray, offsets: np.ndarray):
    """Code points of texts and the offsets of the texts in them."""
    begins = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), begins[offsets]


# The character language model.


def _count_symbols(batches):
    counts = np.zeros(SYMBOLS**4, np.int64)
    symbol = tables()[0]
    for batch in batches:
        for _, data, offsets in text_slices(batch.column(0)):
            codes, starts = _codes(data, offsets)
            # Three edges before every text and one after it, so that no run of four spans two texts.
            chain = np.insert(symbol[codes], np.repeat(starts, 3), 0)
            edge = (chain[1:] == 0) & (chain[:-1] == 0)
            gap = np.zeros(len(chain), bool)
            gap[1:] = edge
            chain = chain[~gap].astype(np.int64)
            # One edge is left between words; a word's first letters see it as often as they need.
            before = np.append(np.zeros(3, np.int64), chain)
            third, second, first = before[:-3], before[1:-2], before[2:-1]
            second = np.where(first == 0, 0, second)
            third = np.where(second == 0, 0, third)
            known = (first > 0) | (chain > 0)
            run = ((third * SYMBOLS + second) * SYMBOLS + first) * SYMBOLS + chain
            counts += np.bincount(run[known], minlength=SYMBOLS**4)
    run = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(run, pa.int32()), pa.array(counts[run])], names=["run", "n"])


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log P(symbol | three before it) of counts of runs of four, shorter runs filling the gaps."""
    runs = counts.reshape((SYMBOLS,) * 4).astype(np.float64)
    known = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(4):
        here = runs.sum(tuple(range(3 - order)))
        known = (here + BACKOFF * known) / (here.sum(-1, keepdims=True) + BACKOFF)
    return np.log(known).astype(np.float32)


def fit_characters(docs: DataFrame, text="text") -> np.ndarray:
    """The language model of all texts: log probabilities, by the three symbols before.

    Counted over every row; the driver gets at most 28 ** 4 sums. Without texts all symbols are alike.
    """
    small_batches(docs.sparkSession)
    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_count_symbols, "run int, n long")
    sums = counted.groupBy("run").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SYMBOLS**4)
    counts[sums.column("run").to_numpy()] = sums.column("n").to_numpy()
    return log_probabilities(counts)


# The decoder.


def readings(chars: str, model: np.ndarray):
    """The lattice of a chain: per character, its readings (cost, what is written, symbol or None)."""
    symbol, _, letter, _ = tables()
    out = []
    for i, c in enumerate(chars):
        if letter[ord(c)]:
            options = [(0.0, c, int(symbol[ord(c)]))]
        else:
            options = [(0.0, c, 0)]
            options += [(SIGN, x, ord(x) - 96) for x in STANDS_FOR.get(c, "")]
            options.append((BETWEEN, "", None))
        if i and chars[i - 1] == c:
            options.append((REPEAT, "", None))
        out.append(options)
    return out


def decode(chars: str, model: np.ndarray) -> str:
    """The best reading of a chain of lower-case characters with edges on both sides.

    Viterbi over the last three symbols written; of equal readings the one that sorts first is taken.
    """
    best = {(0, 0, 0): (0.0, "")}
    for options in readings(chars, model):
        after: dict = {}
        for state, (cost, written) in best.items():
            for extra, more, symbol in options:
                if symbol is None or (symbol == 0 and state[2] == 0):
                    new, total = state, cost + extra
                else:
                    total = cost + extra - float(model[state][symbol])
                    new = (state[1], state[2], symbol) if symbol else (0, 0, 0)
                found = (total, written + more)
                if new not in after or found < after[new]:
                    after[new] = found
        best = after
    closed = [(cost - (float(model[state][0]) if state[2] else 0.0), written) for state, (cost, written) in best.items()]
    return min(closed)[1]


_SIGNS = re.escape("".join(STANDS_FOR))
SUSPICIOUS = re.compile(
    rf"[^\W_](?:[\s._*\-]{{1,2}}[^\W_](?![^\W_])){{2,}}|\S*(?:[^\W\d_][{_SIGNS}]+[^\W\d_]|(\w)\1\1)\S*|[{_SIGNS}]+[^\W\d_]\S*"
)


def restore(text: str, model: np.ndarray) -> str:
    """A text with its suspicious chains replaced by their best readings, in lower case."""
    return SUSPICIOUS.sub(lambda found: decode(found[0].lower(), model), text)


def restore_texts(docs: DataFrame, model: np.ndarray, text="text", restored="restored") -> DataFrame:
    """The rows with a column of restored texts; null stays null."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def apply(texts):
        return texts.map(lambda t: restore(t, shared.value), na_action="ignore")

    return docs.withColumn(restored, apply(F.col(text).cast("string")))


# Skeletons.


class Skeletons:
    """The skeletons of the texts of a slice as one stream, with the places where words may begin and end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        _, skeleton, letter, lower = tables()
        self.codes, self.text_offsets = _codes(data, offsets)
        self.letter, self.lower = letter, lower
        kept = np.flatnonzero(skeleton[self.codes])
        sym, text = skeleton[self.codes[kept]], np.searchsorted(self.text_offsets, kept, "right") - 1
        # Segments: characters side by side in one text.
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) > 1) | (np.diff(text) > 0)
        segment = np.cumsum(new) - 1
        alone = np.bincount(segment)[segment] == 1 if len(segment) else np.zeros(0, bool)
        again = np.zeros(len(kept), bool)
        again[1:] = (sym[1:] == sym[:-1]) & (~new[1:] | (alone[1:] & alone[:-1] & (np.diff(text) == 0)))
        self.begin = kept[~again]  # first character of each run of equal ones
        runs = np.flatnonzero(~again)
        self.end = kept[np.append(runs[1:], len(kept)) - 1] + 1 if len(runs) else kept[:0]
        self.text, self.segment = text[~again], segment[~again]
        n = len(self.begin)
        is_letter = np.maximum.reduceat(letter[self.codes[kept]], runs) if n else np.zeros(0, bool)
        edge = np.ones(n + 1, bool)
        edge[1:-1] = self.segment[1:] != self.segment[:-1]
        self.firsts, self.lasts = np.flatnonzero(edge[:-1]), np.flatnonzero(edge[1:])
        # Signs at the edges of a segment may be meant as signs: words also begin and end with its outer letters.
        letters = np.flatnonzero(is_letter)
        of = self.segment[letters]
        change = np.ones(len(of) + 1, bool)
        change[1:-1] = of[1:] != of[:-1]
        self.inner_firsts, self.inner_lasts = letters[change[:-1]], letters[change[1:]]
        self.starts = np.unique(np.concatenate([self.firsts, self.inner_firsts]))
        self.may_end = np.zeros(n, bool)
        self.may_end[self.lasts] = True
        self.may_end[self.inner_lasts] = True
        self.hash = Rolling(sym[~again])

    def segments(self):
        """(text, hash, hash of the neighbours) of each segment, with and without signs at its edges."""
        whole = self.hash.between(self.firsts, self.lasts + 1)
        text = self.text[self.firsts]
        side = np.where(np.append(text[1:] == text[:-1], False), np.append(whole[1:], U64(0)), U64(0)) if len(text) else whole
        left = np.append(U64(0), np.where(text[1:] == text[:-1], whole[:-1], U64(0))).astype(U64) if len(text) else whole
        around = mix(left * U64(0x9E3779B97F4A7C15) ^ mix(side))
        at = np.searchsorted(self.firsts, self.inner_firsts, "right") - 1
        cut = (self.inner_firsts != self.firsts[at]) | (self.inner_lasts != self.lasts[at])
        inner = self.hash.between(self.inner_firsts[cut], self.inner_lasts[cut] + 1)
        return (
            np.append(text, text[at[cut]]),
            np.append(whole, inner).astype(U64),
            np.append(around, around[at[cut]]).astype(U64),
        )

    def hits(self, lengths: np.ndarray, hashes: np.ndarray):
        """First and last runs of chains with one of the given skeletons (sorted hashes), within a text."""
        found = []
        for length in lengths.tolist():
            first = self.starts[self.starts + length <= len(self.begin)]
            last = first + length - 1
            good = self.may_end[last] & (self.text[first] == self.text[last])
            first, last = first[good], last[good]
            hashed = self.hash.between(first, last + 1)
            at = np.minimum(np.searchsorted(hashes, hashed), len(hashes) - 1)
            same = hashes[at] == hashed
            found.append(np.stack([first[same], last[same]], 1))
        found = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        return found[np.lexsort((found[:, 1], found[:, 0]))]

    def chars(self, first: int, last: int) -> str:
        return "".join(map(chr, self.lower[self.codes[self.begin[first] : self.end[last]]].tolist()))


def _skeleton_of(word: str):
    """(length, hash) of the skeleton of a word."""
    data = np.frombuffer(word.encode(), np.uint8)
    made = Skeletons(data, np.array([0, len(data)]))
    n = len(made.begin)
    return n, int(made.hash.between(np.array([0]), np.array([n]))[0]) if n else 0


def _reading(chars: str, model: np.ndarray) -> str:
    """The best reading; chains with a single one need no lattice."""
    if chars.isalpha() and all(a != b for a, b in zip(chars, chars[1:])):
        return chars
    known = cached("toxicity readings", dict)
    if len(known) > 200_000:
        known.clear()
    if chars not in known:
        known[chars] = decode(chars, model)
    return known[chars]


def _words_found(made: Skeletons, targets, model):
    """(text, word, hash of the word's neighbours) of the restored words of the chains with a target's skeleton."""
    lengths, hashes = targets
    if not len(hashes) or not len(made.begin):
        return
    around_of = _neighbours(made)
    for first, last in made.hits(lengths, hashes).tolist():
        around = around_of(first, last)
        for word in re.findall(r"[^\W\d_]+", _reading(made.chars(first, last), model)):
            yield int(made.text[first]), word, around


def _neighbours(made: Skeletons):
    """A function that hashes the segments before and after a chain."""
    whole = made.hash.between(made.firsts, made.lasts + 1).astype(U64)
    text = made.text[made.firsts]
    place = {int(s): i for i, s in enumerate(made.segment[made.firsts].tolist())}

    def around(first, last):
        a, b = place[int(made.segment[first])] - 1, place[int(made.segment[last])] + 1
        here = int(made.text[first])
        left = int(whole[a]) if a >= 0 and text[a] == here else 0
        right = int(whole[b]) if b < len(whole) and text[b] == here else 0
        return hash((left, right)) & 0x7FFFFFFFFFFFFFFF

    return around


# The word model.


@dataclass
class ToxicWords:
    """Language model, weights of restored words, and the calibration of a document's evidence."""

    characters: np.ndarray
    weights: dict
    calibration: tuple

    def targets(self):
        """Sorted skeleton hashes of the weighted words, and their lengths."""
        made = [_skeleton_of(w) for w in self.weights]
        lengths = np.unique(np.array([n for n, _ in made if n], np.int64))
        return lengths, np.unique(np.array([h for n, h in made if n], U64))

    def score(self, evidence: np.ndarray, greatest: np.ndarray) -> np.ndarray:
        mean, spread, slopes = self.calibration
        x = (_features(evidence, greatest) - mean) / spread
        return 1 / (1 + np.exp(-np.clip(x @ slopes[:-1] + slopes[-1], -30, 30)))


def _features(evidence, greatest):
    return np.stack([evidence, greatest, np.log1p(evidence)], 1)


# Scores of a model that has learnt nothing: 0, but for rounding.
NOTHING_LEARNT = (np.zeros(3), np.ones(3), np.array([0.0, 0.0, 0.0, -30.0]))


def word_weights(toxic: dict, clean: dict, n_toxic: float, n_clean: float) -> dict:
    """Log ratios of the rates of words, from numbers of different contexts, for words that are clearly of toxic texts."""
    share = n_toxic / max(n_toxic + n_clean, 1)
    out = {}
    for word, n in toxic.items():
        other = clean.get(word, 0)
        expected = (n + other) * share
        if n >= LEAST_CONTEXTS and n > expected + 3 * np.sqrt(expected) + 1:
            weight = np.log((n + PRIOR * share) / n_toxic) - np.log((other + PRIOR * (1 - share)) / max(n_clean, 1))
            if weight > LEAST_WEIGHT:
                out[word] = float(weight)
    return out


def _calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Logistic regression by Newton steps: means, spreads and slopes with the intercept last.

    More evidence never lowers a score: features with a negative slope are left out, and the rest is fitted again.
    """
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    used = np.ones(z.shape[1], bool)
    while True:
        slopes, here = np.zeros(z.shape[1]), z[:, used]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(here @ slopes[used], -30, 30)))
            gradient = here.T @ (weight * (y - p)) - RIDGE * slopes[used]
            curvature = (here * (weight * p * (1 - p))[:, None]).T @ here + RIDGE * np.eye(here.shape[1])
            slopes[used] += np.linalg.solve(curvature, gradient)
        if (slopes[:-1] >= 0).all():
            return mean, spread, slopes
        used[:-1] &= slopes[:-1] >= 0


def _segment_rows(batches):
    """(toxic, skeleton, around) of all segments of labelled texts, each once a slice."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for row, data, offsets in text_slices(batch.column("text")):
            text, hashed, around = Skeletons(data, offsets).segments()
            rows = np.unique(np.stack([toxic[row + text].astype(U64), hashed, around], 1), axis=0)
            columns = [pa.array(rows[:, 0].astype(np.int64)), pa.array(rows[:, 1].view(np.int64)), pa.array(rows[:, 2].view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "skeleton", "around"])


def _found_rows(targets, shared):
    def find(batches):
        for batch in batches:
            names = ["key", "toxic", "half", "word", "around"]
            out = {name: [] for name in names}
            known = {name: batch.column(name).to_pylist() for name in ("key", "toxic", "half")}
            for row, data, offsets in text_slices(batch.column("text")):
                made = Skeletons(data, offsets)
                # A row without a word for every text, and one for every restored word.
                found = [(t, None, None) for t in range(len(offsets) - 1)] + list(_words_found(made, targets, shared.value))
                for text, word, around in found:
                    for name in known:
                        out[name].append(known[name][row + text])
                    out["word"].append(word)
                    out["around"].append(around)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types)], names=names)

    return find


def fit_toxicity(docs: DataFrame, labels: DataFrame, doc="doc_id", text="text", toxic="toxic", sample_docs=SAMPLE_DOCS) -> ToxicWords:
    """A model of `docs` and of the labelled rows among them.

    The language model is counted over all of `docs`. The word model is fitted on about `sample_docs`
    documents of either label, drawn by a hash of the id; `labels` holds those that may be learnt from. Of several
    labels of a document the greatest counts; rows without a label, id or text are left out. A word counts once for
    each pair of neighbours it has, so that copies of a text weigh as one. Without documents of
    both labels every score is 0.
    """
    small_batches(docs.sparkSession)
    characters = fit_characters(docs, text)
    known = labels.select(F.col(doc).alias("key"), F.col(toxic).cast("int").alias("toxic")).where("key IS NOT NULL AND toxic IN (0, 1)")
    known = stage(known.groupBy("key").agg(F.max("toxic").cast("long").alias("toxic")), "toxic-labels")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return ToxicWords(characters, {}, NOTHING_LEARNT)
    share = F.when(F.col("toxic") == 1, min(1.0, sample_docs / sizes[1])).otherwise(min(1.0, sample_docs / sizes[0]))
    drawn = known.where(F.pmod(F.xxhash64("key", F.lit("toxicity sample")), F.lit(1 << 20)) < share * (1 << 20))
    # At most about twice sample_docs narrow rows.
    drawn = F.broadcast(drawn.withColumn("half", F.pmod(F.xxhash64("key", F.lit("halves")), F.lit(2)).cast("long")))
    texts = docs.select(F.col(doc).alias("key"), F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    sample = texts.join(drawn, "key").select(F.xxhash64("key").alias("key"), "toxic", "half", "text")

    rows = sample.mapInArrow(_segment_rows, "toxic long, skeleton long, around long").distinct()
    counted = rows.groupBy("skeleton").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    counted = stage(counted, "skeletons")
    n_toxic, n_clean = counted.agg(F.sum("toxic"), F.sum("clean")).first()
    if not n_toxic:
        n_toxic, n_clean = 0, 0
    near = counted.where(F.col("toxic") >= LEAST_CONTEXTS).toArrow()
    weighty = word_weights(
        dict(zip(near.column("skeleton").to_pylist(), near.column("toxic").to_pylist())),
        dict(zip(near.column("skeleton").to_pylist(), near.column("clean").to_pylist())),
        max(n_toxic, 1),
        max(n_clean, 1),
    )
    hashes = np.unique(np.array(list(weighty), np.int64).view(U64))
    targets = (np.arange(1, 65), hashes)

    shared = docs.sparkSession.sparkContext.broadcast(characters)
    schema = "key long, toxic long, half long, word string, around long"
    found = stage(sample.mapInArrow(_found_rows(targets, shared), schema), "toxic-words")
    contexts = found.where("word IS NOT NULL").select("word", "around", "toxic", "half").distinct()
    sums = contexts.groupBy("word", "half").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    sums = sums.toArrow().to_pylist()

    def weights(half=None):
        toxic_n, clean_n = {}, {}
        for r in sums:
            if half is None or r["half"] == half:
                toxic_n[r["word"]] = toxic_n.get(r["word"], 0) + r["toxic"]
                clean_n[r["word"]] = clean_n.get(r["word"], 0) + r["clean"]
        part = 1 if half is None else 2
        return word_weights(toxic_n, clean_n, max(n_toxic, 1) / part, max(n_clean, 1) / part)

    # Evidence of each document by weights of the other half, so that no document vouches for itself.
    halves = [(w, 1 - half, x) for half in (0, 1) for w, x in weights(half).items()]
    table = docs.sparkSession.createDataFrame(halves, "word string, half long, weight double")
    once = found.select("key", "toxic", "half", "word").distinct()
    evidence = once.join(F.broadcast(table), ["word", "half"], "left").groupBy("key", "toxic").agg(
        F.sum(F.coalesce("weight", F.lit(0.0))).alias("evidence"),
        F.max(F.coalesce("weight", F.lit(0.0))).alias("greatest"),
    )
    seen = evidence.orderBy("key").toArrow()
    if not seen.num_rows:
        return ToxicWords(characters, {}, NOTHING_LEARNT)
    x = _features(*(seen.column(n).to_numpy() for n in ("evidence", "greatest")))
    y = seen.column("toxic").to_numpy().astype(float)
    weight = np.where(y == 1, sizes[1] / max(y.sum(), 1), sizes[0] / max((1 - y).sum(), 1))
    weight *= len(y) / weight.sum()
    return ToxicWords(characters, weights(), _calibrated(x, y, weight))


def held_out(doc: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_toxicity(docs: DataFrame, model: ToxicWords, doc="doc_id", text="text", keep_words=False) -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1 from TOXIC_FROM on) and, if asked for, the toxic words as restored.

    Each restored word counts once a document, whatever its disguises. Null and empty texts have no
    words. Repeated rows each get a row; other columns are ignored. Texts are read in whole, in one pass without a shuffle.
    """
    small_batches(docs.sparkSession)
    plain = (model.characters, model.weights, model.calibration)
    shared = docs.sparkSession.sparkContext.broadcast((plain, model.targets()))

    def score(batches):
        plain, targets = shared.value
        fitted = ToxicWords(*plain)
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text")):
                n = len(offsets) - 1
                made = Skeletons(data, offsets)
                words = [set() for _ in range(n)]
                for at, word, _ in _words_found(made, targets, fitted.characters):
                    if word in fitted.weights:
                        words[at].add(word)
                evidence = np.array([sum(fitted.weights[w] for w in sorted(found)) for found in words])
                greatest = np.array([max((fitted.weights[w] for w in found), default=0.0) for found in words])
                scores = fitted.score(evidence, greatest)
                columns = {
                    "doc_id": batch.column("doc_id").slice(row, n),
                    "score": pa.array(scores, pa.float64()),
                    "predicted": pa.array((scores >= TOXIC_FROM).astype(np.int32), pa.int32()),
                }
                if keep_words:
                    columns["words"] = pa.array([sorted(found) for found in words], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double, predicted int" + (", words array<string>" if keep_words else ""))
