"""Language identification of mixed texts.

The script of a word's first letter narrows the candidate languages, hashed character n-grams give
the word a score for each, and a Viterbi pass over a text's words, with a penalty for every switch,
labels its spans. A document gets the language with most letters.

Viterbi runs on all texts of a slice at once: words are cut into short blocks, a block is a matrix
of best scores from any language before it to any language at its end, and matrices combine exactly.
"""

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from goldquarry.llm.common import small_batches
from goldquarry.llm.kernels import cached, text_slices

UNKNOWN = "und"
BUCKETS = 1 << 15
MASK = np.uint32(BUCKETS - 1)
SWITCH = 12.0
BLOCK = 32
# Numbers of the Viterbi matrices that are held at once.
HELD_NUMBERS = 1 << 22
# Documents per language that the model is fitted on, about.
SAMPLE_DOCS = 1500
# A language is a candidate for a script that has this share of its letters in the sample.
SCRIPT_SHARE = 0.01
NO_CANDIDATE = -40.0
SMOOTHING = 0.5

# Code point ranges of scripts.
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("ethiopic", 0x1200, 0x137F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x3134F),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


def _tables():
    """Per code point: 1 letter, 2 mark, 0 other; its lower case; its script."""
    n = 0x110000
    kind, low, script = np.zeros(n, np.uint8), np.arange(n, dtype=np.uint32), np.zeros(n, np.uint8)
    for cp in range(n):
        c = chr(cp)
        category = unicodedata.category(c)[0]
        if category == "L":
            kind[cp] = 1
            lower = c.lower()
            if len(lower) == 1:
                low[cp] = ord(lower)
        elif category == "M":
            kind[cp] = 2
    for name, start, end in SCRIPTS:
        script[start : end + 1] = SCRIPT_NAMES.index(name)
    return kind, low, script


def _shifted(values, by, edges):
    """Neighbours at a distance; 0 across the edges of texts (first positions if by > 0, last ones else)."""
    out = np.zeros_like(values)
    if by > 0:
        out[by:] = values[:-by]
    else:
        out[:by] = values[-by:]
    out[edges] = 0
    return out


class Words:
    """The words of the texts of one slice, with the n-gram buckets of their letters."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind_of, low_of, script_of = cached("language tables", _tables)
        begins = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
        self.text_offsets = begins[offsets]
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(codes)
        kind = kind_of[codes]
        low = np.where(kind > 0, low_of[codes], 0).astype(np.uint32)
        firsts = self.text_offsets[:-1][self.text_offsets[:-1] < n]
        lasts = self.text_offsets[1:][self.text_offsets[1:] > 0] - 1
        before = _shifted(low, 1, firsts) if n else low
        after = _shifted(low, -1, lasts) if n else low
        self.starts = np.flatnonzero((low > 0) & (before == 0))
        self.ends = np.flatnonzero((low > 0) & (after == 0)) + 1
        self.first = np.searchsorted(self.starts, self.text_offsets)
        self.scripts = script_of[codes[self.starts]]
        # Three and four characters around each letter; 0 stands for the edge of a word.
        two_before = np.where(before > 0, np.append(np.zeros(1, np.uint32), before[:-1]), 0).astype(np.uint32)
        three = (before * np.uint32(0x9E3779B1) ^ low) * np.uint32(0x85EBCA77) ^ after
        four = three * np.uint32(0xC2B2AE3D) ^ two_before * np.uint32(0x27D4EB2F)
        self.buckets = []
        for grams in (three, four):
            grams = grams * np.uint32(0x165667B1)
            self.buckets.append(np.where(low > 0, (grams >> np.uint32(16)) & MASK, BUCKETS))
        letters = np.zeros(n + 1, np.int64)
        np.cumsum(kind == 1, out=letters[1:])
        self.letters = letters[self.ends] - letters[self.starts]

    def scores(self, model) -> np.ndarray:
        """Score of each word for each language."""
        tables, bias = model
        out = bias[self.scripts].astype(np.float64)
        for j in range(out.shape[1]):
            letters = np.zeros(len(self.buckets[0]) + 1)
            np.cumsum(sum(tables[k][j][b] for k, b in enumerate(self.buckets)), out=letters[1:])
            out[:, j] += letters[self.ends] - letters[self.starts]
        return out


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best label of every word; words of text d are first[d] .. first[d + 1]."""
    total, n = scores.shape
    if not total:
        return np.zeros(0, np.int64)
    sizes = np.diff(first)
    per_text = -(-sizes // BLOCK)
    text = np.repeat(np.arange(len(sizes)), per_text)
    block_first = np.cumsum(per_text) - per_text
    index = np.arange(len(text)) - block_first[text]
    start = first[text] + index * BLOCK
    length = np.minimum(BLOCK, sizes[text] - index * BLOCK)
    blocks = len(text)
    at = np.minimum(start[:, None] + np.arange(BLOCK), total - 1)
    here = np.arange(BLOCK) < length[:, None]

    # Parts of few blocks, by their place in the text: the matrices of a part are all that is held at once.
    order = np.argsort(index, kind="stable")
    size = max(1, HELD_NUMBERS // (n * max(n, BLOCK)))
    parts = [order[i : i + size] for i in range(0, blocks, size)]

    def steps(part):
        """Blocks of a part that stand at one place of their texts, place by place."""
        for some in np.split(part, np.flatnonzero(np.diff(index[part])) + 1):
            yield some, text[some]

    # Best score from the language before a block to the one of its last word; then block after block, all texts at once.
    enter = np.zeros((blocks, n))
    state = np.zeros((len(sizes), n))
    place = np.empty(blocks, np.int64)
    for part in parts:
        best = np.where(np.eye(n, dtype=bool), 0.0, -np.inf)[None].repeat(len(part), 0)
        for t in range(BLOCK):
            step = np.maximum(best, best.max(2, keepdims=True) - penalty) + scores[at[part, t]][:, None, :]
            best = np.where(here[part, t, None, None], step, best)
        place[part] = np.arange(len(part))
        for now, texts in steps(part):
            state[texts] -= state[texts].max(1, keepdims=True)
            enter[now] = state[texts]
            state[texts] = (state[texts][:, :, None] + best[place[now]]).max(1)

    # Once more inside the blocks, now with the true scores before them; then back from any end.
    last = state.argmax(1)
    labels = np.empty(total, np.int64)
    for part in reversed(parts):
        stay, came = np.ones((BLOCK, len(part), n), bool), np.zeros((BLOCK, len(part)), np.int64)
        value = enter[part]
        for t in range(BLOCK):
            came[t] = value.argmax(1)
            switched = value.max(1, keepdims=True) - penalty
            stay[t] = value >= switched
            value = np.where(here[part, t, None], np.maximum(value, switched) + scores[at[part, t]], value)
        path = np.zeros((BLOCK, len(part), n), np.int32)
        label = np.tile(np.arange(n), (len(part), 1))
        for t in range(BLOCK - 1, -1, -1):
            path[t] = label
            before = np.where(np.take_along_axis(stay[t], label, 1), label, came[t][:, None])
            label = np.where(here[part, t, None], before, label)
        place[part] = np.arange(len(part))
        chosen = np.zeros(len(part), np.int64)
        for now, texts in reversed(list(steps(part))):
            chosen[place[now]] = last[texts]
            last[texts] = label[place[now], last[texts]]
        picked = path[:, np.arange(len(part)), chosen].T
        labels[(start[part, None] + np.arange(BLOCK))[here[part]]] = picked[here[part]]
    return labels


def held_out(doc: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _gram_counts(languages):
    place = {name: i for i, name in enumerate(languages)}

    def count(batches):
        grams = np.zeros((len(languages), 2, BUCKETS + 1), np.int64)
        scripts = np.zeros((len(languages), len(SCRIPT_NAMES)), np.int64)
        for batch in batches:
            labels = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
            for row, data, offsets in text_slices(batch.column(0)):
                words = Words(data, offsets)
                language = labels[row : row + len(offsets) - 1]
                of_word = np.repeat(language, np.diff(words.first))
                np.add.at(scripts, (of_word, words.scripts), words.letters)
                of_char = np.repeat(language, np.diff(words.text_offsets))
                for k, buckets in enumerate(words.buckets):
                    both = np.bincount(of_char * (BUCKETS + 1) + buckets, minlength=len(languages) * (BUCKETS + 1))
                    grams[:, k] += both.reshape(len(languages), -1)
        grams[:, :, BUCKETS] = 0
        flat = np.concatenate([grams.reshape(len(languages), -1), scripts], axis=1)
        language, slot = np.nonzero(flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(language), pa.array(slot), pa.array(flat[language, slot])], names=["language", "slot", "n"]
        )

    return count


def fit_languages(docs: DataFrame, text="text", lang="lang", sample_key="doc_id", sample_docs: int = SAMPLE_DOCS):
    """Languages and score tables, fitted on about `sample_docs` labelled documents per language.

    The sample is drawn by a hash of `sample_key`; rows without a label or text are left out. The
    counts that reach the driver are bounded by the number of n-gram buckets per language.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = sorted((r[0], r[1]) for r in labelled.groupBy(lang).count().collect())
    languages = [name for name, _ in sizes]
    if not languages:
        return [], None
    share = F.create_map(*[F.lit(x) for name, n in sizes for x in (name, min(1.0, sample_docs / n))])
    drawn = F.pmod(F.xxhash64(F.col(sample_key), F.lit("language sample")), F.lit(1 << 20)) < share[F.col(lang)] * (1 << 20)
    sample = labelled.where(drawn).select(F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    counted = sample.mapInArrow(_gram_counts(languages), "language long, slot long, n long")
    slots = 2 * (BUCKETS + 1)
    table = np.zeros((len(languages), slots + len(SCRIPT_NAMES)))
    sums = counted.groupBy("language", "slot").agg(F.sum("n").alias("n")).toArrow()
    table[sums.column("language").to_numpy(), sums.column("slot").to_numpy()] = sums.column("n").to_numpy()
    grams = table[:, :slots].reshape(len(languages), 2, BUCKETS + 1)
    total = grams[:, :, :BUCKETS].sum(2, keepdims=True)
    logs = np.log((grams + SMOOTHING) / (total + SMOOTHING * BUCKETS))
    logs -= logs.max(0, keepdims=True)
    logs[:, :, BUCKETS] = 0.0
    scripts = table[:, slots:]
    shares = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
    candidates = (shares >= SCRIPT_SHARE).T
    bias = np.where(candidates | ~candidates.any(1, keepdims=True), 0.0, NO_CANDIDATE)
    return languages, (logs.transpose(1, 0, 2).astype(np.float32), bias)


PREDICTED = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
SPANS = T.ArrayType(T.StructType().add("start", "long").add("end", "long").add("lang", "string"))
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])


def identify(docs: DataFrame, fitted, doc="doc_id", text="text", spans=False, keep_columns=False) -> DataFrame:
    """Per document: doc_id, lang_pred, score and, if asked for, spans (start, end in code points, lang).

    With keep_columns the rows are those of `docs` with these columns in place of any of their names.

    score is the share of the text's letters that lie in spans of lang_pred. A null text, one without
    letters, and any text if nothing was learned, gives `und`, score 0 and no spans. Ties go to the
    language that sorts first. Repeated rows each get a row; other columns are ignored. Texts are
    read in whole; one narrow pass without a shuffle.
    """
    small_batches(docs.sparkSession)
    languages, model = fitted
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                words = Words(data, offsets)
                if languages:
                    labels = viterbi(words.scores(shared.value), words.first)
                    of_word = np.repeat(np.arange(n), np.diff(words.first))
                    share = np.bincount(
                        of_word * len(languages) + labels, weights=words.letters, minlength=n * len(languages)
                    ).reshape(n, -1)
                    letters, best = share.sum(1), share.argmax(1)
                else:
                    letters, best = np.zeros(n), np.zeros(n, np.int64)
                names = [languages[b] if m else UNKNOWN for b, m in zip(best, letters)]
                scores = [share[i, b] / m if m else 0.0 for i, (b, m) in enumerate(zip(best, letters))]
                columns = {name: batch.column(name).slice(row, n) for name in kept}
                columns |= {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}
                if spans:
                    columns["spans"] = _spans(words, labels if languages else None, languages)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    if keep_columns:
        others = [c for c in docs.columns if c not in (doc, text, "doc_id", "text", "lang_pred", "score", "spans")]
        rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"), *others)
    kept = rows.columns if keep_columns else ["doc_id"]
    schema = T.StructType([f for f in rows.schema.fields if f.name in kept] + PREDICTED)
    return rows.mapInArrow(predict, schema.add("spans", SPANS) if spans else schema)


def _spans(words: Words, labels, languages):
    """Runs of words of one label, per text."""
    n = len(words.first) - 1
    if labels is None or not len(labels):
        return pa.array([[]] * n, pa.list_(SPAN))
    new = np.ones(len(labels), bool)
    new[1:] = labels[1:] != labels[:-1]
    new[words.first[:-1][words.first[:-1] < len(labels)]] = True
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(labels)) - 1
    text = np.searchsorted(words.first, begin, "right") - 1
    base = words.text_offsets[text]
    values = pa.StructArray.from_arrays(
        [
            pa.array(words.starts[begin] - base),
            pa.array(words.ends[end] - base),
            pa.array([languages[i] for i in labels[begin]], pa.string()),
        ],
        fields=list(SPAN),
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), values)
