"""The queries of the numbered operators and their SQL twins; digest columns are derived from the operators' results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import bpe, chat, contamination, languages, manifest, pages, resampling, rules, secret_scan, simhash, suffixes, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The vocabulary that the byte-level BPE query encodes with.
RANKS = "byte_bpe_multi_50k.tiktoken"

#: The url rules of the contract: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return register


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


@query("op1_url_filter", """
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
judged AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                          WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                          WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                          WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
""")
def op1_url_filter(spark, base):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.filter_urls(table(spark, base, "pages"), rules, keep=["page_id"])


@query("op6_decontamination", """
WITH doc_words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
item_at AS (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS gram, len(w[i:i + 12]) AS size FROM item_at),
sizes AS (SELECT DISTINCT size FROM grams),
doc_at AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size),
hits AS (SELECT DISTINCT doc_id, i, a.size, item FROM doc_at a JOIN grams g ON g.size = a.size AND g.gram = array_to_string(w[i:i + a.size - 1], ' ')),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""")
def op6_decontamination(spark, base):
    found = contamination.find_benchmark(table(spark, base, "documents"), table(spark, base, "benchmark"), keep=["doc_id"])
    return contamination.contamination(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op9_chat_format", """
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (SELECT *, length(text) + len(regexp_extract_all(text, '[\\\\<>\\[\\]]')) + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13
                 WHEN 'assistant' THEN 9 ELSE 16 + length(role) + len(regexp_extract_all(role, '[\\\\<>\\[\\]]')) END AS size FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""")
def op9_chat_format(spark, base):
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, base, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(F.lit(-7).cast(turns.schema["conv_id"].dataType), F.col("id").cast(turns.schema["turn"].dataType),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(said))
    return chat.digest_examples(chat.expand_targets(chat.format_conversations(turns.unionAll(control))))


@query("op10_byte_bpe")
def op10_byte_bpe(spark, base):
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    coded = bpe.round_trip(table(spark, base, "documents"), vocabulary, keep=["doc_id"])
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark, base):
    found = simhash.near_duplicates(table(spark, base, "documents").select("doc_id", "text"), shingle=4, radius=4)
    return found.select("doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query("op2_suffix_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, p, substring(h, 2 * p + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM d WHERE len(h) >= 200)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS nth FROM windows) WHERE nth > 1),
islands AS (SELECT doc_id, p, sum(CASE WHEN p > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS island
            FROM (SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM again)),
runs AS (SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM islands GROUP BY doc_id, island),
gaps AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS prev FROM runs),
kept AS (SELECT doc_id, string_agg(substring(h, 2 * prev + 1, 2 * (s - prev)), '' ORDER BY s) || substring(any_value(h), 2 * max(e) + 1) AS k,
                sum(e - s) AS removed, count(*) AS spans FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""")
def op2_suffix_dedup(spark, base):
    documents = table(spark, base, "documents").select("doc_id", "text")
    found = suffixes.remove_repeats(documents, length=100, keep=["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_quality_rules", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w FROM d),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM again) GROUP BY doc_id),
lines AS (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^ \\x09-\\x0D]') GROUP BY doc_id, line),
dups AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines, CAST(sum(n - 1) AS BIGINT) AS n_dup FROM lines GROUP BY doc_id),
facts AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                 CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines,
                 coalesce(n, 0) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '[a-z]')) AS n_lower,
                 len(regexp_extract_all(t, '[A-Za-z]|[^\\x00-\\x7F]')) AS n_letters
          FROM base LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 3 * word_chars OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_upper > 60 * (n_upper + n_lower)
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_letters < word_chars) AS kept
FROM judged
""")
def op3_quality_rules(spark, base):
    measured = rules.measure(table(spark, base, "documents"), keep=["doc_id"])
    judged = rules.apply_policies(rules.ledger(measured), rules.BASE, rules.STANDARD)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~F.col("kept_base_v1")).alias("base_failed"), F.col("kept_standard_v1").alias("kept"))


@query("op4_toxicity")
def op4_toxicity(spark, base):
    documents = table(spark, base, "documents").select("doc_id", "text")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(documents, table(spark, base, "labels"), ~held)
    scored = toxicity.score_texts(documents, model, keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op5_html_extraction")
def op5_html_extraction(spark, base):
    found = table(spark, base, "pages")
    return pages.extract(found, pages.train(found), keep=["page_id", "url"]).select("page_id", "url", "text", "n_chars")


@query("op8_language_id")
def op8_language_id(spark, base):
    documents = table(spark, base, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(languages.remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = languages.train(documents.where(~held))
    found = languages.identify(documents.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


#: SQL of the reflected CRC-32: its table by the rule of the polynomial 0xEDB88320, and the CRC of a text's UTF-8 bytes.
CRC_TABLE = """SELECT list(c ORDER BY n) AS crcs FROM (SELECT n, list_reduce(list_prepend(n, range(8)),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) AS t(n))"""
CRC_OF = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode({0}))),
    lambda i: CAST('0x' || substring(hex(encode({0})), 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])))"""



def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(one) for one in ("doc_id", "source", "lang", n_chars, "text")) + ")"


@query("op11_merkle_manifest", f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
leaves AS (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
                  CASE WHEN {CRC_OF.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS altered
           FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
tree AS (SELECT lang, 0 AS level, place, leaf AS node, n FROM placed
         UNION ALL SELECT lang, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY lang, level, place // 2, n),
subroots AS (SELECT lang, node AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
crown AS (SELECT 0 AS level, place, subroot AS node, n FROM subroots
          UNION ALL SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2 FROM crown WHERE n > 1 GROUP BY level, place // 2, n),
below AS (SELECT p.doc_id, t.level, t.place, xor(p.place >> t.level, 1) AS other, t.lang FROM placed p JOIN tree t
          ON t.lang IS NOT DISTINCT FROM p.lang AND t.place = p.place >> t.level AND t.n > 1),
above AS (SELECT p.doc_id, s.height + c.level AS level, c.place, xor(s.place >> c.level, 1) AS other, c.level AS own FROM placed p
          JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN crown c ON c.place = s.place >> c.level AND c.n > 1),
steps AS (SELECT doc_id, b.level, b.place % 2 = 1 AS is_right, coalesce(t.node, '') AS sibling FROM below b
          LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM b.lang AND t.level = b.level AND t.place = b.other
          UNION ALL SELECT doc_id, a.level, a.place % 2 = 1, coalesce(c.node, '') FROM above a LEFT JOIN crown c ON c.level = a.own AND c.place = a.other),
paths AS (SELECT doc_id, list(struct_pack(is_right := is_right, sibling := sibling) ORDER BY level) AS path FROM steps GROUP BY doc_id),
folds AS (SELECT doc_id, altered AS node, coalesce(path, []) AS path, 1 AS k FROM leaves LEFT JOIN paths USING (doc_id)
          UNION ALL SELECT doc_id, sha256(CASE WHEN path[k].is_right THEN path[k].sibling || node ELSE node || path[k].sibling END), path, k + 1
          FROM folds WHERE k <= len(path)),
root AS (SELECT node AS root FROM crown WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.sibling), '')) AS proof_sha256, f.node AS folded_root,
       f.node = root AS verified
FROM placed p JOIN folds f USING (doc_id) JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang, root WHERE k = len(path) + 1
""")
def op11_merkle_manifest(spark, base):
    documents = table(spark, base, "documents")
    named = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    # beyond the largest bigint, one more is still the next number
    altered = [*named[:3], F.col("n_chars").cast("decimal(38,0)") + 1, named[4]]
    leaf = manifest.leaf_digest(*named)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, manifest.leaf_digest(*altered)).otherwise(leaf)
    made = manifest.build_manifest(documents, leaf, F.col("doc_id"), F.col("lang"), {"doc_id": F.col("doc_id"), "tampered": tampered})
    proofs = manifest.prove_leaves(made).withColumn("folded_root", manifest.fold(F.col("carried.tampered"), F.col("path")))
    return proofs.select("carried.doc_id", "leaf", "subroot", "root", manifest.path_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))



@query("op12_secret_scan")
def op12_secret_scan(spark, base):
    found = secret_scan.scan(table(spark, base, "documents"), keep=["doc_id"])

    def written(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base_spans = F.filter("secrets", lambda x: x["kind"].isin(*secret_scan.BASE))
    return found.select("doc_id", *[number(kind) for kind in secret_scan.BASE], F.sha2(written(base_spans), 256).alias("base_sha256"),
                        written(F.col("secrets")).alias("spans"))


def _features_sql(table: str) -> str:
    return f"""SELECT *, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM (
    SELECT *, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM {table})"""


@query("op13_importance_resampling", f"""
WITH crc AS ({CRC_TABLE}), d AS ({_features_sql("documents")}), b AS ({_features_sql("benchmark")}),
source AS (SELECT f, count(*) AS n FROM (SELECT unnest(f) AS f FROM d) GROUP BY f), target AS (SELECT f, count(*) AS n FROM (SELECT unnest(f) AS f FROM b) GROUP BY f),
hashed AS (SELECT f, {CRC_OF.format("f")} % 10000 AS bucket FROM (SELECT f FROM source UNION SELECT f FROM target), crc),
s AS (SELECT bucket, sum(n) AS s FROM source JOIN hashed USING (f) GROUP BY bucket), t AS (SELECT bucket, sum(n) AS t FROM target JOIN hashed USING (f) GROUP BY bucket),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM s) + 10000 AS DOUBLE))
                 / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST((SELECT sum(t) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
          FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM (SELECT doc_id, unnest(f) AS f FROM d) JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, CAST(len(f) AS BIGINT) AS n_features, len(w) AS n_words, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substring(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
           FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
""")
def op13_importance_resampling(spark, base):
    drawn = resampling.resample(table(spark, base, "documents"), table(spark, base, "benchmark"), keep=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
