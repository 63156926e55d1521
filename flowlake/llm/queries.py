"""Registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm.chat import format_chats, read_loss, read_turns, text_part
from flowlake.llm.decontam import contamination
from flowlake.llm.hmm import score_texts
from flowlake.llm.jaccard import jaccard_classes
from flowlake.llm.langid import fit_languages, identify
from flowlake.llm.mixing import mix_sources
from flowlake.llm.phrases import phrase_dedup
from flowlake.llm.pivots import pivot_clusters
from flowlake.llm.squares import periodic_runs
from flowlake.llm.substrings import substring_dedup
from flowlake.llm.token_counts import token_counts
from flowlake.llm.token_files import read_token_files, write_token_files
from flowlake.llm.vectors import near_vectors
from flowlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: (node, weight) of the registered mixture; nodes not listed weigh 1.
MIX_WEIGHTS = [
    (["reference"], 3.0), (["web"], 1.0),
    (["web", "en"], 6.0), (["web", "de"], 3.0), (["reference", "en"], 2.0),
    (["web", "en", "src0"], 2.0), (["web", "de", "src0"], 4.0), (["reference", "en", "src1"], 5.0),
]
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.6, 2, 7


def domain_column():
    """Two domains of the given sources: even numbers are web, odd ones reference."""
    return F.when(F.col("source").rlike("[02468]$"), "web").otherwise("reference")


def op1_mix_sources(spark, sf_dir):
    weights = spark.createDataFrame(MIX_WEIGHTS, "node array<string>, weight double")
    levels = [domain_column(), F.col("lang"), F.col("source")]
    mixed = mix_sources(table(spark, sf_dir, "documents"), levels, weights, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select("doc_id", domain_column().alias("domain"), "lang", "source", "mix_tokens", "mix_copies", "mix_prefix")


def op2_language_id(spark, sf_dir):
    docs, held_out = table(spark, sf_dir, "documents"), remainder(4) == 2
    found = identify(docs, fit_languages(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")


def op3_near_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_substring_dedup(spark, sf_dir):
    done = substring_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_jaccard_join(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def remainder(count: int):
    """crc32 of the document id as text, modulo ``count``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % count


def op6_hmm_score(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"), remainder(7) == 2)


def op7_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    rows = rows.union(spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], rows.schema))
    done = format_chats(rows.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))
    turns, loss = read_turns(F.col("formatted")), read_loss(F.col("formatted"), F.col("loss_spans"))
    listed = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), ["source", "text"])


def op9_benchmark_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def looped_tails(docs):
    """``documents`` with the last words of every tenth text, by hash, repeated from a place and at a period by hash."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.withColumn("g", F.floor(hashed / 10)).withColumn(
        "ws", F.when((hashed % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    )
    n, a, p = F.size("ws"), F.col("a"), F.col("p")
    chosen = chosen.withColumn("a", (F.col("g") % n).cast("int"))
    chosen = chosen.withColumn("p", (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("ws", a + 1, p), F.ceil((n - a) / p).cast("int")))
    looped = F.array_join(F.concat(F.slice("ws", 1, a), F.slice(tail, 1, n - a)), " ")
    return chosen.select("doc_id", F.when(F.col("ws").isNotNull(), looped).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(looped_tails(table(spark, sf_dir, "documents")))
    runs, r = F.col("runs"), F.col("best")
    longer = lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best)
    listed = F.transform(runs, lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    lines = F.when(F.size(runs) > 0, F.concat(F.array_join(listed, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", F.when(F.size(runs) > 0, F.aggregate(runs, runs[0], longer))).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"),
        F.floor(1000 * r["length"] / r["period"]).alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op12_pivot_clusters(spark, sf_dir):
    start = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    return pivot_clusters(table(spark, sf_dir, "embeddings"), start)


def op13_phrase_dedup(spark, sf_dir):
    done = phrase_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_language_id": op2_language_id,
    "op3_near_vectors": op3_near_vectors,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_hmm_score": op6_hmm_score,
    "op7_chat_format": op7_chat_format,
    "op8_token_counts": op8_token_counts,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_token_files": op10_token_files,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_pivot_clusters": op12_pivot_clusters,
    "op13_phrase_dedup": op13_phrase_dedup,
}


def mix_sql() -> str:
    """The mixture over whole tables: one water-filling per level, then a running sum per leaf."""
    weights = ", ".join(f"({node}, {weight}::DOUBLE)" for node, weight in MIX_WEIGHTS)
    names, steps = ["l0", "l1", "l2"], []
    for k in range(3):
        own, parent = ", ".join(names[: k + 1]), ", ".join(names[:k])
        by = f"PARTITION BY {parent}" if parent else ""
        budget = f"(SELECT floor(sum(supply) * {MIX_SHARE}::DOUBLE) FROM leaf)" if k == 0 else f"f{k - 1}.given"
        up = "" if k == 0 else f"JOIN f{k - 1} USING ({parent})"
        steps.append(f"""
n{k} AS (SELECT {own}, cap, weight, budget, cap / weight AS ratio FROM (
    SELECT c.*, coalesce(w.weight, 1) AS weight, {budget} AS budget
    FROM (SELECT {own}, sum(supply)::DOUBLE * {MIX_EPOCHS} AS cap FROM leaf GROUP BY {own}) c {up}
    LEFT JOIN weights w ON w.node = [{own}]) WHERE weight > 0),
v{k} AS (SELECT *, (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
         FROM n{k} WINDOW o AS ({by} ORDER BY ratio, {names[k]})),
f{k} AS (SELECT {own}, CASE WHEN level < ratio THEN weight * max(CASE WHEN level < ratio THEN level END) OVER ({by}) ELSE cap END AS given
         FROM v{k})""")
    return rf"""
WITH weights(node, weight) AS (VALUES {weights}),
d AS (SELECT doc_id, lang, source, CASE WHEN regexp_matches(source, '[02468]$') THEN 'web' ELSE 'reference' END AS l0,
             coalesce(lang, '') AS l1, coalesce(source, '') AS l2,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS tokens FROM documents),
leaf AS (SELECT l0, l1, l2, sum(tokens) AS supply FROM d GROUP BY ALL),{",".join(steps)},
p AS (SELECT l0, l1, l2, CAST(supply AS BIGINT) AS supply, CAST(floor(coalesce(given, 0) + 1e-6) AS BIGINT) AS take
      FROM leaf LEFT JOIN f2 USING (l0, l1, l2)),
q AS (SELECT d.*, CASE WHEN supply > 0 THEN take // supply ELSE 0 END AS epoch,
             take - (CASE WHEN supply > 0 THEN take // supply ELSE 0 END) * supply AS rest FROM d JOIN p USING (l0, l1, l2)),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY l0, l1, l2
          ORDER BY md5('{MIX_SEED}:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null'))
          ROWS UNBOUNDED PRECEDING) - tokens AS before FROM q)
SELECT doc_id, l0 AS domain, lang, source, tokens AS mix_tokens,
       CAST(epoch + CASE WHEN before + tokens < rest THEN 1 ELSE 0 END AS BIGINT) AS mix_copies,
       CAST(CASE WHEN before < rest AND rest <= before + tokens THEN rest - before ELSE 0 END AS BIGINT) AS mix_prefix
FROM r"""


def clusters_sql(count: int = 8, rounds: int = 10) -> str:
    """The rounds spelled out; squared distances by exact sums of integers in doubles."""
    distance = "list_inner_product(q, q) - 2 * list_inner_product(q, c) + list_inner_product(c, c)"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (SELECT vec_id, q, arg_min(n, (d, n)) AS n, CAST(min(d) AS BIGINT) AS d
       FROM (SELECT vec_id, q, n, {distance} AS d FROM v, c{k}) GROUP BY vec_id, q)""")
        if k < rounds:
            steps.append(f"""
s{k} AS (SELECT n, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS k
       FROM (SELECT n, unnest(q) AS x, unnest(range(len(q))) AS p FROM a{k}) GROUP BY n, p),
m{k} AS (SELECT n, list(CAST((s - ((s % k) + k) % k) // k AS DOUBLE) ORDER BY p) AS c FROM s{k} GROUP BY n),
c{k + 1} AS MATERIALIZED (SELECT c{k}.n, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (n))""")
    return f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS n, q AS c
    FROM (SELECT q, sha256('3:' || vec_id) AS h FROM v ORDER BY h LIMIT {count})),{",".join(steps)},
t AS (SELECT n, CAST(sum(d) AS BIGINT) AS s FROM a{rounds} GROUP BY n)
SELECT vec_id, CAST(n AS INTEGER) AS cluster, d AS distance, s AS cluster_inertia,
       CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN t USING (n) JOIN c{rounds} USING (n)"""


#: Words of every text, numbered from 1 within a document.
WORDS = r"""
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM documents"""

ORACLE = {
    "op4_substring_dedup": rf"""
WITH d AS ({WORDS}),
n AS (SELECT doc_id, ws, len(ws) AS k FROM d),
w AS (SELECT doc_id, i, list_aggregate(ws[i:i + 12], 'string_agg', ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, k - 11)) AS i FROM n WHERE k >= 13)),
o AS (SELECT g, min(doc_id) AS first_id FROM w GROUP BY g),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
      FROM w JOIN o USING (g) WHERE first_id < doc_id),
x AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id)
SELECT n.doc_id, CAST(k AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(ws, lambda w, j: NOT list_contains(coalesce(gone, []), j)), ' '), '')) AS kept_sha256
FROM n LEFT JOIN x ON n.doc_id = x.doc_id""",
    "op13_phrase_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS h FROM documents),
b AS (SELECT doc_id, p, hex(h[p + 1:p + 1]) AS byte, CASE WHEN p + 100 <= octet_length(h) THEN md5(h[p + 1:p + 100]) END AS g
      FROM (SELECT doc_id, h, unnest(range(octet_length(h))) AS p FROM d)),
o AS (SELECT g, min((doc_id, p)) AS first_at FROM b WHERE g IS NOT NULL GROUP BY g HAVING count(*) > 1),
x AS (SELECT doc_id, p, byte, max(CASE WHEN first_at < (doc_id, p) THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id ORDER BY p ROWS 99 PRECEDING) AS gone
      FROM b LEFT JOIN o USING (g)),
y AS (SELECT *, gone > coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), 0) AS opens FROM x),
k AS (SELECT doc_id, count(*) AS n_bytes, sum(gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
             string_agg(byte, '' ORDER BY p) FILTER (gone = 0) AS kept FROM y GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id""",
    "op9_benchmark_decontamination": r"""
WITH split AS (
    SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
lists AS (
    SELECT side, id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM split),
words AS (SELECT side, id, len(ws) AS n, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM lists),
runs AS (SELECT *, string_agg(w, ' ') OVER four AS g, count(*) OVER four AS k FROM words
         WINDOW four AS (PARTITION BY side, id ORDER BY p ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
lined AS (
    SELECT DISTINCT d.id AS doc_id, i.id AS item_id, d.p - i.p AS shift, i.n AS item_n
    FROM runs d JOIN runs i ON d.g = i.g AND d.k = 4 AND i.k = 4
    WHERE d.side = 'd' AND i.side = 'i' AND i.n >= 5),
pairs AS (
    SELECT doc_id, item_id, shift, least(item_n, 13) AS size, i.p AS ip, CAST(i.w = d.w AS INT) AS same
    FROM lined JOIN words i ON i.side = 'i' AND i.id = item_id
    JOIN words d ON d.side = 'd' AND d.id = doc_id AND d.p = i.p + shift),
long AS (SELECT *, sum(same) OVER v AS m, count(*) OVER v AS c FROM pairs WHERE size = 13
         WINDOW v AS (PARTITION BY doc_id, item_id, shift ORDER BY ip ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
short AS (SELECT doc_id, item_id, shift, size, min(ip) AS ip, sum(same) AS m, count(*) AS c FROM pairs
          WHERE size < 13 GROUP BY doc_id, item_id, shift, size),
held AS (
    SELECT doc_id, item_id, m, size, ip + shift AS dp, ip FROM long WHERE c = 13 AND m >= 11
    UNION ALL
    SELECT doc_id, item_id, m, size, ip + shift, ip FROM short WHERE c = size AND m >= size - CAST(size >= 8 AS INT))
SELECT doc_id, item_id, CAST(m AS BIGINT) AS n_matched, CAST(size AS BIGINT) AS n_window,
       CAST(dp AS BIGINT) AS doc_start, CAST(ip AS BIGINT) AS item_start
FROM held QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY m DESC, dp, ip) = 1""",
    "op7_chat_format": r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\!')) AS r,
             length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS x FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + r + 1 + x + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op1_mix_sources": mix_sql(),
    "op12_pivot_clusters": clusters_sql(),
    "op3_near_vectors": """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(id, other) AS (SELECT a, b FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(other) FROM reach WHERE id = vec_id), vec_id)) AS component_id,
       vec_id <= coalesce((SELECT min(other) FROM reach WHERE id = vec_id), vec_id) AS kept
FROM embeddings""",
    "op5_jaccard_join": r"""
WITH RECURSIVE lists AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
       FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM lists WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS k FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.k + y.k - c)),
reach(id, other) AS (SELECT a, b FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
least_of AS (SELECT id, min(other) AS m FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(k, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of ON least_of.id = d.doc_id""",
}
