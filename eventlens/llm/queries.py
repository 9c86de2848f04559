"""The thin queries over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_runtime_defaults
from .common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_defaults(spark)
            ship(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op5_mixing", r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS tie FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weights AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM totals),
ranked AS (
  SELECT *, cap / weight AS ratio,
    1.5::DOUBLE * sum(source_size) OVER () AS all_words,
    coalesce(sum(cap) OVER (ORDER BY cap / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_cap,
    sum(weight) OVER (ORDER BY cap / weight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM weights),
level AS (SELECT arg_min((all_words - before_cap) / open_weight, ratio) FILTER (WHERE (all_words - before_cap) / open_weight <= ratio) AS level FROM ranked),
targets AS (SELECT source, source_size, least(cap, weight * level) AS target FROM ranked, level),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('17:' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start FROM targets),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, tie) AS place FROM sizes)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + floor((rate - floor(rate)) * place + start) - floor((rate - floor(rate)) * (place - 1) + start)))::BIGINT AS taken
FROM placed JOIN rates ON placed.source IS NOT DISTINCT FROM rates.source
""")
def op5_mixing(table):
    """Words that the mix takes of every document."""
    from .mixing import mix_plan

    plan = mix_plan(table("documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op8_decontamination", r"""
WITH texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
  SELECT kind, id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM texts),
sh AS (
  SELECT DISTINCT kind, id, unnest(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) > 0),
items AS (SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS n FROM sh WHERE kind = 1)
SELECT d.id AS doc_id, item_id, n AS n_item_shingles, count(*) AS n_shared, count(*) / n::DOUBLE AS containment
FROM sh d JOIN items USING (s) WHERE d.kind = 0
GROUP BY d.id, item_id, n HAVING count(*) >= 0.8::DOUBLE * n - 1e-9
""")
def op8_decontamination(table):
    """Documents and the benchmark items they contain."""
    from .decontam import contamination

    return contamination(table("documents"), table("benchmark"))


@query("op10_quality_rules", r"""
WITH d AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, unnest(generate_series(1, len(w) - 2)) AS i, w FROM d WHERE len(w) >= 3),
grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM win),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE c > 1) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
    (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)),
f AS (
  SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
    + 8 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::BIGINT + 16 * (2 * n_dup_lines > n_lines)::BIGINT
    + 32 * (n_words > 100000)::BIGINT)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
  failed & 3 <> 0 AS base_failed, failed & 31 = 0 AS kept FROM f
""")
def op10_quality_rules(table):
    """Measurements, failure bits and verdict (policy strict_v1) of every document."""
    from .quality import POLICIES, ledger, verdicts

    judged = verdicts(ledger(table("documents")), "strict_v1")
    base = F.col("failed").bitwiseAND(F.lit(POLICIES["base_v1"]).cast("long")) != 0
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed", base.alias("base_failed"), "kept")


@query("op3_warc", r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p),
o AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS owner FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN owner <> page_id THEN owner END AS refers_to FROM o
""")
def op3_warc(table):
    """Every page as it reads back from the archives."""
    from .common import folder
    from .warc_zip import read_archives, records, write_archives

    pages = table("pages")
    path = folder(pages.sparkSession, "warc")
    back = read_archives(write_archives(records(pages), path), path)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_simhash")
def op4_simhash(table):
    """Fingerprint and near-duplicate component of every document."""
    from .simhash import components, fingerprint_text

    c = components(table("documents"))
    return c.select("doc_id", fingerprint_text("fp").alias("fingerprint"), "component_id")


@query("op6_language_id")
def op6_language_id(table):
    """Predicted language of every document; learned outside the held-out part."""
    from .langid import held_out, predict, train, training_part

    docs = table("documents").select("doc_id", "text", "lang")
    judged = predict(docs.select("doc_id", "text"), train(training_part(docs)))
    return judged.select("doc_id", held_out().alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


@query("op1_token_ids")
def op1_token_ids(table):
    """Start, length and checksum of every document's ids, read back from the files."""
    import public_tokenizers

    from .common import folder
    from .token_binary import read_ids, write_ids

    docs = table("documents")
    path = folder(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, path, public_tokenizers.path("byte_bpe_50k.json")), path)


@query("op2_url_filter")
def op2_url_filter(table):
    """Host, path, rule and verdict of every page's url."""
    from .url_filter import Rule, judge

    rules = (Rule("allow", "org"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
    judged = judge(table("pages").select("page_id", "url"), rules)
    return judged.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"), F.col("__verdict").alias("verdict")
    )


@query("op7_suffix_array")
def op7_suffix_array(table):
    """What is left of every document without its repeated 200-byte strings."""
    from .suffix_dedup import remove_repeats

    return remove_repeats(table("documents"), keep_text=False).drop("kept")


@query("op9_line_runs", r"""
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
s AS (
  SELECT doc_id, x, list_filter(generate_series(1, len(x)), lambda i: regexp_matches(x[i], '[^\x20\x09-\x0D]')) AS pl FROM l),
w AS (
  SELECT doc_id, depth, p, array_to_string(list_transform(pl[p:p + depth - 1], lambda i: md5(x[i])), ',') AS run
  FROM (SELECT *, unnest(generate_series(1, len(pl) - depth + 1)) AS p
        FROM (SELECT *, unnest([2, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096]) AS depth FROM s) WHERE len(pl) >= depth)),
c AS (SELECT doc_id, depth, p FROM (SELECT *, row_number() OVER (PARTITION BY depth, run ORDER BY doc_id, p) AS nth FROM w) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest([p, p + 1]) AS p FROM c WHERE depth = 2),
runs AS (
  SELECT doc_id, count(*)::BIGINT AS n_removed, count(*) FILTER (WHERE brk)::BIGINT AS n_runs, list(p) AS ps
  FROM (SELECT doc_id, p, p - lag(p, 1, -1) OVER (PARTITION BY doc_id ORDER BY p) <> 1 AS brk FROM gone) GROUP BY doc_id),
deep AS (SELECT doc_id, max(depth)::BIGINT AS longest FROM c GROUP BY doc_id)
SELECT doc_id, len(x)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs,
  coalesce(longest, 0)::BIGINT AS longest_repeat,
  sha256(array_to_string(list_transform(list_filter(generate_series(1, len(x)), lambda i: ps IS NULL OR NOT list_contains(list_transform(ps, lambda p: pl[p]), i)), lambda i: x[i]), chr(10))) AS kept_sha256
FROM s LEFT JOIN runs USING (doc_id) LEFT JOIN deep USING (doc_id)
""")
def op9_line_runs(table):
    """What is left of every document without later copies of repeated line runs."""
    from .line_dedup import remove_runs

    left = remove_runs(table("documents"))
    return left.select("doc_id", "n_lines", "n_removed", "n_runs", "longest_repeat", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
""")
def op11_exact_dedup(table):
    """Every document with the copy that stays in its place."""
    from .exact_dedup import exact_groups

    return exact_groups(table("documents"))


@query("op12_conversation_trie", r"""
WITH bits AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v FROM range(256) r(i))),
turns AS (
  SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x, length(coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id AS c, list({'x': x, 'n': n} ORDER BY turn NULLS FIRST, x) AS s FROM turns GROUP BY conv_id),
shares AS (
  SELECT c, s, c - c % 100 AS base,
    xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda y: ascii(y)::BIGINT), lambda a, y: xor(t[(xor(a, y) & 255) + 1], a >> 8), 4294967295), 4294967295) % 6 AS h
  FROM own, bits),
built AS (SELECT a.c, list_concat(coalesce(b.s[1:a.h], []), a.s[a.h + 1:]) AS s FROM shares a LEFT JOIN own b ON b.c = a.base),
m AS (
  SELECT c, d, md5(array_to_string(list_transform(s[1:d], lambda y: y.x), ',')) AS k, md5(array_to_string(list_transform(s[1:d - 1], lambda y: y.x), ',')) AS p,
    CASE WHEN d > 0 THEN s[d].n ELSE 0 END AS chars, len(s) = d AS ends
  FROM (SELECT c, s, unnest(generate_series(0, len(s))) AS d FROM built)),
nodes AS (
  SELECT d, k, min(p) AS p, min(c) AS c, count(*) AS n_convs, min(chars) AS chars, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY d, k),
kids AS (SELECT d - 1 AS d, p AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
totals AS (
  SELECT m.d, m.k, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((nodes.n_convs - 1) * nodes.chars)::BIGINT AS saved_tokens
  FROM nodes LEFT JOIN kids USING (d, k) JOIN m ON m.c = nodes.c AND m.d <= nodes.d GROUP BY m.d, m.k)
SELECT nodes.c AS conv_id, nodes.d AS depth, up.c AS parent_conv_id, nodes.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN totals USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN nodes up ON up.d = nodes.d - 1 AND up.k = nodes.p AND nodes.d > 0
""")
def op12_conversation_trie(table):
    """Every node of the trie of rebuilt conversations with its subtree's totals."""
    from .conversation_trie import prefix_trie

    return prefix_trie(table("conversations"))


@query("op13_conversation_repair")
def op13_conversation_repair(table):
    """Faults, cheapest edits and repaired hash of every damaged conversation."""
    from .conversation_repair import repair

    return repair(table("conversations"))
