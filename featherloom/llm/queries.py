"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import Book, Tables
from featherloom.llm import chat, collocations, decontaminate, jaccard, licenses, merkle, mixing, quality, secret_scan, sharding, simhash, suffix_dedup, toxicity
from featherloom.llm.common import word_count

book = Book()


def _rule_sql(rank: int, rule: secret_scan.Rule) -> str:
    text, pattern = "coalesce(text, '')", f"$${rule.pattern}$$"
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, {rule.least} AS least, string_split_regex({text}, {pattern}) AS gaps,
 regexp_extract_all({text}, {pattern}, 0) AS hits, regexp_extract_all({text}, {pattern}, {rule.group}) AS parts FROM documents"""


SECRETS = f"""
WITH m AS ({" UNION ALL ".join(_rule_sql(i, r) for i, r in enumerate(secret_scan.RULES))}),
e AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
f AS (SELECT doc_id, kind, rank, length(hits[i]) AS n,
  list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS a FROM e WHERE length(parts[i]) >= least),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + n AS BIGINT), ',' ORDER BY a, rank) AS spans FROM f GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN g USING (doc_id)"""


@book.add("op1_secret_scan", SECRETS)
def secret_findings(t: Tables):
    rows = secret_scan.summary(t.documents, "doc_id", "text")
    base = F.array_join(F.filter(F.split("spans", ","), lambda s: F.rlike(s, F.lit("^(assign|access|hex):"))), ",")
    return rows.select(F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"), "spans")


@book.add("op3_quality_rules")
def quality_rules(t: Tables):
    return quality.judge(t.documents.select("doc_id", "lang", "source", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("d2", 6).alias("d2"))


@book.add("op6_sharding")
def feistel_shards(t: Tables):
    body = F.coalesce("text", F.lit(""))
    rows = t.documents.select("doc_id", (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"))
    return sharding.assign(rows, 40, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# the level is found in the order of limit / weight, as the operator does; the rest is plain windows
MIX = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s),
r AS (SELECT *, sum(cap) OVER o - cap AS caps, sum(weight) OVER o - weight AS weights, sum(source_size) OVER () AS t, sum(weight) OVER () AS tw FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
f AS (SELECT *, cap * (tw - weights) <= (t - caps) * weight AS is_full FROM r),
g AS (SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE ((t - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) * weight)::DOUBLE / (tw - coalesce(sum(weight) FILTER (is_full) OVER (), 0)) END AS target FROM f),
p AS (SELECT d.*, source_size, target, CAST(round(target) AS BIGINT) AS budget, sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id || ':11'), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size > 0 THEN budget // source_size * size + greatest(0, least(size, budget % source_size - before)) ELSE 0 END AS BIGINT) AS taken FROM p"""


@book.add("op7_mixing", MIX)
def mix_to_weights(t: Tables):
    rows = mixing.plan(t.documents.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


CONTROL_TURN = "</s>[INST] ok [/INST]"
# code points that escaping adds: one per backslash and per control string
_CONTROLS = [c.decode() for c in chat.CONTROLS]
_ADDED = " + ".join([r"(length(text) - length(replace(text, '\\', '')))"] + [
    f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in _CONTROLS])
_FIXED = sum(map(len, (chat.OPEN, chat.BREAK, chat.CLOSE)))


@book.add("op8_chat_format", f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TURN}'), (-7, 1, 'assistant', '{CONTROL_TURN}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_FIXED} + length(role) + length(text) + {_ADDED}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""")
def chat_format(t: Tables):
    extra = t.spark.createDataFrame([(-7, 0, "user", CONTROL_TURN), (-7, 1, "assistant", CONTROL_TURN)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(t.conversations.select("conv_id", "turn", "role", "text").unionByName(extra)))


@book.add("op10_toxicity")
def toxicity_scores(t: Tables):
    docs = t.documents.select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, t.labels))
    return scored.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@book.add("op2_simhash_near_dedup")
def simhash_components(t: Tables):
    rows = simhash.near_duplicates(t.documents.select("doc_id", "text"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@book.add("op9_decontamination")
def benchmark_hits(t: Tables):
    return decontaminate.contaminated(t.documents.select("doc_id", "text"), t.benchmark.select("item_id", "text"))


@book.add("op5_license_scan")
def license_notices(t: Tables):
    return licenses.scan(t.documents.select("doc_id", "text")).withColumn("differences", F.array_join("differences", "; "))


# every window of 50 bytes beside the smallest document it starts in
REPEATS = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, array_slice(b, i + 1, i + 50) AS s FROM (SELECT doc_id, b, unnest(range(0, n - 49)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first_doc FROM w GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
bad AS (SELECT doc_id, i FROM w JOIN f USING (s) WHERE doc_id > first_doc),
r AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM bad),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM r),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM g GROUP BY doc_id, run),
e AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM runs),
k AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(z - a) AS BIGINT) AS n_removed, max(z) AS tail,
  string_agg(CASE WHEN a > since THEN hex(array_slice(b, since + 1, a)) ELSE '' END, '' ORDER BY a) AS head FROM e JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  CASE WHEN tail IS NULL THEN sha256(b) ELSE sha256(unhex(head || CASE WHEN n > tail THEN hex(array_slice(b, tail + 1, n)) ELSE '' END)) END AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""


@book.add("op4_suffix_dedup", REPEATS)
def repeated_strings(t: Tables):
    rows = suffix_dedup.remove_repeats(t.documents.select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                       F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# crc32 bit by bit over the decimal digits; trees level by level; the way to the root level by level
_FIELD = "coalesce(CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_BITS = ", ".join(["CAST(0 AS BIGINT)"] * 8)
MERKLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {_LEAF.format("text")} AS leaf, {_LEAF.format("replace(text, chr(10), '')")} AS cut,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, c: list_reduce(list_concat([xor(a, c)], [{_BITS}]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) AS crc FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d),
up AS (SELECT source, 0 AS h, i, leaf AS x, n FROM o
  UNION ALL SELECT source, h + 1, i // 3, sha256(string_agg(x, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM up WHERE n > 1 GROUP BY source, h, i // 3),
s AS (SELECT source, x AS subroot, h AS top, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
over AS (SELECT 0 AS h, i, subroot AS x, n FROM s
  UNION ALL SELECT h + 1, i // 3, sha256(string_agg(x, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM over WHERE n > 1 GROUP BY h, i // 3),
inner_side AS (SELECT a.source, a.h, a.i, coalesce(string_agg(b.x, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.x, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM up a JOIN up b ON a.source IS NOT DISTINCT FROM b.source AND a.h = b.h AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY 1, 2, 3),
over_side AS (SELECT a.h, a.i, coalesce(string_agg(b.x, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.x, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM over a JOIN over b ON a.h = b.h AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY 1, 2),
w AS (SELECT o.source, o.i AS leaf_no, 0 AS h, o.i, CASE WHEN crc % 2 = 0 THEN cut ELSE leaf END AS x, '' AS p FROM o
  UNION ALL SELECT w.source, leaf_no, w.h + 1, w.i // 3, sha256(l || x || r), p || l || r FROM w JOIN inner_side k ON k.source IS NOT DISTINCT FROM w.source AND k.h = w.h AND k.i = w.i),
v AS (SELECT w.source, leaf_no, 0 AS h, s.i, x, p FROM w JOIN s ON s.source IS NOT DISTINCT FROM w.source AND w.h = s.top
  UNION ALL SELECT v.source, leaf_no, v.h + 1, v.i // 3, sha256(l || x || r), p || l || r FROM v JOIN over_side k ON k.h = v.h AND k.i = v.i),
z AS (SELECT x AS root, h AS top FROM over WHERE n = 1)
SELECT o.doc_id, o.leaf, s.subroot, z.root, sha256(v.p) AS proof_sha256, v.x AS folded_root, v.x = z.root AS verified
FROM o JOIN s ON s.source IS NOT DISTINCT FROM o.source CROSS JOIN z JOIN v ON v.source IS NOT DISTINCT FROM o.source AND v.leaf_no = o.i AND v.h = z.top"""


@book.add("op13_merkle_manifest", MERKLE)
def manifest(t: Tables):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    cut = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    rows = t.documents.select("doc_id", "source", merkle.leaf(*fields, F.col("text")).alias("leaf"),
                              F.when(cut, merkle.leaf(*fields, F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered"))
    proved = merkle.proofs(rows, "source", "doc_id", "leaf")
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


_GRAMS = " UNION ALL ".join(f"SELECT lang, {k} AS k, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS p FROM w WHERE len(w) >= {k}"
                            for k in range(1, 6))
_CUTS = " UNION ALL ".join(f"SELECT lang, phrase, a, k, {m} AS m, array_to_string(w[1:{m}], ' ') AS p, array_to_string(w[{m + 1}:], ' ') AS q FROM c WHERE k > {m}" for m in range(1, 5))
_PARTS = " UNION ALL ".join(f"SELECT lang, a, array_to_string(w[{i}:{i + m - 1}], ' ') AS phrase FROM c WHERE k > {m} AND k >= {i + m - 1}" for m in range(2, 5) for i in range(1, 7 - m))
PHRASES = rf"""
WITH s AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') AS w FROM s),
f AS (SELECT lang, k, p AS phrase, count(*) AS a FROM ({_GRAMS}) GROUP BY 1, 2, 3),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 100),
cuts AS ({_CUTS}),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, m, l.a AS l, r.a AS r, n, CAST(CAST(1000 AS HUGEINT) * cuts.a * n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = cuts.p JOIN f r ON r.lang = cuts.lang AND r.phrase = cuts.q JOIN n ON n.lang = cuts.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, m) = 1),
inside AS (SELECT lang, phrase, max(a) AS longer FROM ({_PARTS}) GROUP BY 1, 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR longer < a
QUALIFY rank <= 2000"""


@book.add("op12_phrase_collocations", PHRASES)
def phrase_collocations(t: Tables):
    return collocations.collocations(t.documents.select("lang", "text"))


@book.add("op11_jaccard_join")
def jaccard_components(t: Tables):
    return jaccard.components(t.documents.select("doc_id", "text"))
