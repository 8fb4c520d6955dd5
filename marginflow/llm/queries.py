"""Registered queries of the corpus operators: each applies one operator, with its production
parameters, to a whole table and returns the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm import decontaminate, max_sketch, order_minhash, outliers, packing, pii, preference, prefix_trie, secret_scan, sharding, style_tree, suffix, warc
from marginflow.llm.common import new_path, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(warc.dedupe_plan(table(spark, sf_dir, "pages"), "page_id", "url", "html"), path)
    r = warc.read_records(spark, path)
    return r.select(
        warc.page_of(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")).cast("long").alias("refers_to"),
    )


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op7_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.pairs_of(preference.conversations_of(table(spark, sf_dir, "conversations")))
    return preference.flat(preference.format_pairs(pairs))


def op8_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = outliers.quality_rules(table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_max_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = max_sketch.build_index(table(spark, sf_dir, "documents"))
    return max_sketch.search(index, table(spark, sf_dir, "benchmark"), k=10).withColumnRenamed("id", "doc_id")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_order_minhash": op2_order_minhash,
    "op3_pii": op3_pii,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_preference": op7_preference,
    "op8_style_tree": op8_style_tree,
    "op9_sharding": op9_sharding,
    "op10_outliers": op10_outliers,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_max_sketch": op12_max_sketch,
    "op13_secret_scan": op13_secret_scan,
}

ORACLE_SQL = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f""",
    "op6_decontamination": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                   FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
              FROM benchmark),
        win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
                FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM win),
        dw AS (SELECT rid, sizes.n, unnest(range(1, len(w) - sizes.n + 2)) AS i, w FROM d, sizes WHERE len(w) >= sizes.n),
        hit AS (SELECT dw.rid, dw.i, dw.n, win.item_id FROM (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM dw) dw JOIN win ON win.win = dw.win AND win.n = dw.n),
        cover AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
        items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN cover USING (rid) LEFT JOIN items USING (rid)""",
    "op7_preference": """
        WITH c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS t
                   FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'none') AS role, coalesce(text, '') AS text FROM conversations) GROUP BY conv_id),
        n AS (SELECT *, lead(conv_id) OVER w AS next_id, lead(t) OVER w AS next_t,
                     list_position([x.role = 'assistant' FOR x IN t], true) AS head,
                     len(t) + 1 - list_position(list_reverse([x.role = 'assistant' FOR x IN t]), true) AS last
              FROM c WINDOW w AS (PARTITION BY t[1] ORDER BY conv_id)),
        p AS (SELECT conv_id AS chosen_id, next_id AS rejected_id, t AS a,
                     CASE WHEN next_t IS NOT NULL THEN next_t WHEN coalesce(head, 0) = 0 THEN t
                          ELSE list_concat(list_concat(t[:last - 1], CASE WHEN head < last THEN [t[head]] ELSE [] END), t[last + 1:]) END AS b
              FROM n),
        s AS (SELECT *, coalesce((SELECT min(i) - 1 FROM (SELECT unnest(range(1, greatest(len(a), len(b)) + 1)) AS i) WHERE a[i] IS DISTINCT FROM b[i]), len(a)) AS k FROM p)
        SELECT chosen_id, rejected_id, CAST(k AS BIGINT) AS n_shared, len(a) = k AND len(b) = k AS tie,
               coalesce(array_to_string(['<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10) FOR x IN a[:k]], ''), '') AS prompt,
               coalesce(array_to_string(['<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10) FOR x IN a[k + 1:]], ''), '') AS chosen,
               coalesce(array_to_string(['0:' || (13 + length(x.role)) || CASE WHEN x.role = 'assistant' THEN ',1:' ELSE ',0:' END || (length(x.text) + 10) || ',0:1' FOR x IN a[k + 1:]], ','), '') AS chosen_mask,
               coalesce(array_to_string(['<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10) FOR x IN b[k + 1:]], ''), '') AS rejected,
               coalesce(array_to_string(['0:' || (13 + length(x.role)) || CASE WHEN x.role = 'assistant' THEN ',1:' ELSE ',0:' END || (length(x.text) + 10) || ',0:1' FOR x IN b[k + 1:]], ','), '') AS rejected_mask
        FROM s""",
    "op11_prefix_trie": r"""
        WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT c, list({'role': role, 'text': text} ORDER BY turn ASC NULLS FIRST, role, text) AS t FROM t GROUP BY c),
        bits AS (SELECT c, t, [ascii(x) FOR x IN string_split(CAST(c AS VARCHAR), '')] AS b FROM o),
        crc AS (SELECT c, t, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(x AS BIGINT) FOR x IN b]),
                    lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS r FROM bits),
        heads AS (SELECT c, t, xor(r, 4294967295) % 4 AS h FROM crc),
        s AS (SELECT x.c, list_concat(coalesce(list_slice(y.t, 1, x.h), []), list_slice(x.t, x.h + 1, len(x.t))) AS s FROM heads x LEFT JOIN o y ON y.c = x.c - x.c % 20),
        p AS (SELECT c, CAST(d AS BIGINT) AS d, list_slice(s, 1, d) AS p, len(s) = d AS ends FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM s)),
        n AS (SELECT p, d, min(c) AS c, count(*) AS n, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends FROM p GROUP BY p, d),
        k AS (SELECT list_slice(p, 1, d - 1) AS p, d - 1 AS d, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
        w AS (SELECT n.*, coalesce(kids, 0) AS kids, CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * len(regexp_extract_all(n.p[n.d].text, '[^\x20\x09-\x0D]+')) END AS saved
              FROM n LEFT JOIN k ON k.p = n.p AND k.d = n.d),
        up AS (SELECT list_slice(p, 1, e) AS p, CAST(e AS BIGINT) AS d, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
               FROM (SELECT p, kids, saved, unnest(range(0, d + 1)) AS e FROM w) GROUP BY ALL)
        SELECT CAST(w.c AS BIGINT) AS conv_id, w.d AS depth, CAST(f.c AS BIGINT) AS parent_conv_id, CAST(w.n AS BIGINT) AS n_convs, CAST(w.kids AS BIGINT) AS n_children,
               CAST(up.leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
        FROM w JOIN up ON up.p = w.p AND up.d = w.d LEFT JOIN n f ON f.d = w.d - 1 AND f.p = list_slice(w.p, 1, w.d - 1)""",
    "op12_max_sketch": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                   FROM documents),
        b AS (SELECT row_number() OVER () AS q, item_id,
                     regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
              FROM benchmark),
        total AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(w)) AS BIGINT) AS nt FROM d WHERE len(w) > 0),
        t AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
        idf AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM t, total GROUP BY term, nd),
        asked AS (SELECT q, term, CAST(count(*) AS BIGINT) AS times FROM (SELECT q, unnest(w) AS term FROM b) GROUP BY q, term),
        len AS (SELECT r, doc_id, 100 - 75 + ((75 * CAST(len(w) AS BIGINT) * nd) // nt) AS m FROM d, total WHERE len(w) > 0),
        s AS (SELECT q, r, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
              FROM asked JOIN idf USING (term) JOIN t USING (term) JOIN len USING (r) GROUP BY q, r),
        o AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s JOIN len USING (r) WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o JOIN b USING (q) WHERE rank <= 10""",
}
