"""Catalogue queries of the operators, each over its whole table, with SQL where SQL can say it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from goldquarry.llm import (
    chaining,
    chat_format,
    decontaminate,
    embeddings,
    language,
    licenses,
    minhash,
    negatives,
    packing,
    periodic,
    suffix_dedup,
    toxicity,
    url_filter,
)
from goldquarry.llm.common import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SEQUENCE_TOKENS = 1024
# The rules every url is held against.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
# Rows of the labelled url table, half of them for either verdict.
URL_SAMPLE = 2000
# A conversation that holds the template's own control strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"
UPPER, LOWER = url_filter.UPPER, url_filter.LOWER


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_chat_formatting",
    r"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL
      SELECT -7, t.turn, t.role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
    ), written AS (
      SELECT *, regexp_replace(text, '(\\*)(### |</turn>)', '\\\1\2', 'g') AS escaped,
        replace(replace(replace(replace(role, '\', '\b'), ':', '\c'), '#', '\h'), '<', '\l') AS escaped_role
      FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
      CAST(sum(length(escaped_role) + length(escaped) + 15) AS BIGINT) AS formatted_chars
    FROM written GROUP BY conv_id
    """,
)
def op1_chat_formatting(spark, sf_dir):
    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    return chat_format.read_back(chat_format.format_conversations(conversations.unionByName(extra)))


@query("op3_packing")
def op3_packing(spark, sf_dir):
    packed = packing.pack(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_TOKENS
    )
    return packed


def fit_on_training_part(documents: DataFrame):
    """The language model of the documents that are not held out."""
    return language.fit_languages(documents.where(~language.held_out(F.col("doc_id"))))


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    predicted = language.identify(documents, fit_on_training_part(documents))
    return predicted.withColumn("held_out", language.held_out(F.col("doc_id")))


def _license_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    spaced = "' ' || trim(regexp_replace(regexp_replace({text}, {line}, '', 'g'), {word}, '  ', 'g')) || ' '"
    spaced = spaced.format(
        text=f"translate(text, '{UPPER}', '{LOWER}')",
        line=quoted(licenses.COPYRIGHT_LINE),
        word=quoted(licenses.NOT_WORD),
    )
    for other, common in licenses.SPELLINGS:
        spaced = f"replace({spaced}, ' {other} ', ' {common} ')"
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.KNOWN)
    return f"""
    WITH known AS (SELECT * FROM (VALUES {known}) k(license_id, text)),
    known_words AS (SELECT license_id, {spaced} AS words FROM known),
    known_digests AS (
      SELECT sha256(words) AS digest, min(license_id) AS license_id FROM known_words WHERE trim(words) <> '' GROUP BY 1
    ),
    doc_words AS (SELECT doc_id, {spaced} AS words FROM documents)
    SELECT doc_id, CASE WHEN trim(words) <> '' THEN sha256(words) END AS digest, license_id
    FROM doc_words LEFT JOIN known_digests ON trim(words) <> '' AND digest = sha256(words)
    """


@query("op5_license_scan", _license_sql())
def op5_license_scan(spark, sf_dir):
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


@query("op6_url_filter")
def op6_url_filter(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    # The labelled table: of the different urls that a rule decides, the first of each verdict by a hash.
    name, verdict = url_filter.rule_columns(*url_filter.host_and_path(F.col("url")), URL_RULES)
    decided = pages.where(name.isNotNull()).select("url", (verdict == "block").cast("int").alias("label")).distinct()
    first = lambda label: decided.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(URL_SAMPLE // 2)
    # Stored: the fit reads it in every step.
    labelled = stage(first(0).unionByName(first(1)), "labelled-urls")
    return url_filter.judge_urls(pages, url_filter.fit_url_model(labelled), URL_RULES)


_WORDS = "regexp_extract_all(translate(text, '{0}', '{1}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(UPPER, LOWER)


@query(
    "op7_decontamination",
    f"""
    WITH docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    item_windows AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS k,
        array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS run
      FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) r(i) WHERE len(w) > 0
    ),
    doc_runs AS (
      SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS run
      FROM docs, (SELECT DISTINCT k FROM item_windows) ks, unnest(range(1, len(w) - k + 2)) r(i)
    ),
    hits AS (SELECT DISTINCT doc_id, item_id, i, k FROM doc_runs JOIN item_windows USING (k, run)),
    hit_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM hits, unnest(range(i, i + k)) r(p) GROUP BY doc_id),
    hit_items AS (
      SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit_words.n, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(hit_items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(hit_words.n, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
)
def op7_decontamination(spark, sf_dir):
    found = decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op2_minhash_dedup")
def op2_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op8_embedding_dedup")
def op8_embedding_dedup(spark, sf_dir):
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark, sf_dir):
    kept = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), keep_text=False)
    return kept.drop("kept")


@query("op10_substring_dedup")
def op10_substring_dedup(spark, sf_dir):
    return chaining.repeated_passages(read(spark, sf_dir, "documents"))


@query("op11_toxicity")
def op11_toxicity(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score_toxicity(documents, toxicity.fit_toxicity(documents, labels))
    return scored.withColumn("held_out", toxicity.held_out(F.col("doc_id")))


@query(
    "op12_hard_negatives",
    """
    WITH sound AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS components
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
        CAST(list_dot_product(a.components, r.components) AS BIGINT) AS score
      FROM sound a JOIN sound r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
    ), positives AS (
      SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER found AS INTEGER) AS rank, id AS negative_id,
      positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
    WINDOW found AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
    QUALIFY rank <= 10
    """,
)
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.mine_negatives(vectors, F.col("vec_id") % 100 == 0, vector="embedding")


# crc32 of a decimal id, bit by bit: every byte is followed by eight shifts.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END))"""
_BLANK_SEPARATED = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"


@query(
    "op13_periodic_runs",
    f"""
    WITH plain AS (
      SELECT doc_id, coalesce({_BLANK_SEPARATED.format('text')}, []) AS w, {_CRC32} AS h FROM documents
    ), shaped AS (
      SELECT *, len(w) AS n, (h // 10) % len(w) AS a, h // 10 AS g FROM plain
    ), changed AS (
      SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
        w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM shaped
    ), word AS (
      SELECT doc_id, len(w) AS n, unnest(range(len(w))) AS i, unnest(w) AS word FROM changed
    ), equal AS (
      SELECT x.doc_id, y.i - x.i AS period, x.i AS i
      FROM word x JOIN word y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
    ), island AS (
      SELECT *, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM equal
    ), stretch AS (
      SELECT doc_id, period, min(i) AS start, count(*) + period AS length FROM island GROUP BY doc_id, period, island
    ), run AS (
      SELECT doc_id, start, length, min(period) AS period FROM stretch WHERE length >= greatest(6, 4 * period)
      GROUP BY doc_id, start, length
    ), listed AS (
      SELECT doc_id, count(*) AS n_runs, first(run ORDER BY length DESC, start, period) AS best,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
      FROM run GROUP BY doc_id
    ), repeated AS (
      SELECT DISTINCT doc_id, i FROM run, unnest(range(start + period, start + length)) r(i)
    ), kept AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
      FROM word LEFT JOIN (SELECT *, true AS gone FROM repeated) USING (doc_id, i) WHERE gone IS NULL GROUP BY doc_id
    )
    SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, best.start AS start,
      CAST(best.length AS BIGINT) AS length, CAST(best.period AS BIGINT) AS period,
      CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
      sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
    FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
)
def op13_periodic_runs(spark, sf_dir):
    # Every tenth document, by its id's checksum, repeats part of itself.
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    parts = F.struct(words.alias("w"), F.floor(checksum / 10).cast("long").alias("g"))

    def repeating(made):
        w, g = made["w"], made["g"]
        n = F.size(w).cast("long")
        start = g % n
        period = 1 + F.floor((n - start) / (3 + g % 8)).cast("long")
        place = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period).cast("int")
        words = F.transform(w, lambda word, i: F.get(w, place(i.cast("long"))))
        return F.when(n > 0, F.array_join(words, " ")).otherwise("")

    made = F.transform(F.array(parts), repeating)[0]
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.when((checksum % 10 == 0) & F.col("text").isNotNull(), made).otherwise(F.col("text"))
    found = periodic.find_runs(documents.withColumn("text", text))
    longest = F.reduce(
        "runs",
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda best, run: F.when(best.isNull() | (run["length"] > best["length"]), run).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
