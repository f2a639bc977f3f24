"""The registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestep.llm import chat, classifier, exact, manifest, packing, paragraphs, pieces, rules, secret_scan, shards, simhash, spelling, suffix
from lodestep.llm.common import prepare, read
from lodestep.session import new_path


def bpe_file() -> str:
    """The byte-level BPE file of the token queries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_file() -> str:
    """The SentencePiece model of the segmentation query."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def new_index(spark: SparkSession) -> str:
    """An empty digest index of its own for one run, with a bucket for each shuffle partition."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return exact.open_index(spark, f"digests_{uuid.uuid4().hex}", new_path(spark, "index"), buckets)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in secret_scan.KINDS],
                        F.sha2(secret_scan.listed("spans", secret_scan.KINDS[:3]), 256).alias("base_sha256"),
                        secret_scan.listed("spans").alias("spans"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(read(spark, sf_dir, "documents"), bpe_file(), with_ids=False).drop("ids")


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    target = new_path(spark, "shards")
    shards.write(read(spark, sf_dir, "documents"), bpe_file(), target)
    return shards.checked(shards.read(spark, target))


def op4_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    return classifier.score(docs, classifier.learn(docs, read(spark, sf_dir, "labels")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix.remove_repeats(read(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = pieces.encode(read(spark, sf_dir, "documents"), piece_file(), with_ids=False, decoded="decoded")
    return found.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("ids", "decoded")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact.decide(read(spark, sf_dir, "documents"), new_index(spark))


def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return paragraphs.near_duplicates(read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return manifest.check(read(spark, sf_dir, "documents"))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    out = chat.format_trees(chat.from_turns(turns.unionByName(planted)))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (out.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("masked", chat.read_loss(F.col("formatted"), F.col("loss")))
            .select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"), F.length("masked").cast("long").alias("loss_chars"),
                    F.sha2("masked", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spelling.variants(read(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (op1_secret_scan, op2_packing, op3_shards, op4_classifier, op5_quality_rules, op6_simhash, op7_suffix_dedup,
                                   op8_sentencepiece, op9_exact_dedup, op10_paragraph_dedup, op11_merkle_manifest, op12_chat_formatting,
                                   op13_spelling_variants)}

#: CRC-32 in SQL: the table by its rule, and a fold over the bytes of a text with a placeholder for the text.
_CRC_TABLE = """steps(i, c, k) AS (SELECT i, i, 0 FROM range(256) r(i) UNION ALL
                    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
        crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8)"""


def _crc32(text: str) -> str:
    byte = f"list_transform(range(1, strlen({text}) + 1), lambda j: ('0x' || substr(hex(encode({text})), 2 * j - 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


def _sql_field(name: str, value: str | None = None) -> str:
    text = f"({value or name})::VARCHAR"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _sql_leaf(n_chars: str) -> str:
    return f"sha256({' || '.join([*map(_sql_field, ('doc_id', 'source', 'lang')), _sql_field('n_chars', n_chars), _sql_field('text')])})"


def _sql_escaped(text: str) -> str:
    for plain, marked in chat.ESCAPES:
        text = f"replace({text}, '{plain}', '{marked}')"
    return text


SQL = {
    "op11_merkle_manifest": f"""
        WITH RECURSIVE {_CRC_TABLE},
        leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS grp, {_sql_leaf('n_chars')} AS leaf,
                          CASE WHEN {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_sql_leaf('n_chars + 1')} ELSE {_sql_leaf('n_chars')} END AS changed,
                          row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS total
                   FROM documents, crc),
        inner_tree(grp, level, pos, node, total) AS (
            SELECT grp, 0, pos, leaf, total FROM leaves
            UNION ALL SELECT grp, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (max(total) + 1) // 2
                      FROM inner_tree WHERE total > 1 GROUP BY grp, level, pos // 2),
        subroots AS (SELECT grp, node AS subroot, level AS height, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS total
                     FROM inner_tree WHERE total = 1),
        top_tree(level, pos, node, total) AS (
            SELECT 0, pos, subroot, total FROM subroots
            UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (max(total) + 1) // 2
                      FROM top_tree WHERE total > 1 GROUP BY level, pos // 2),
        nodes AS (SELECT grp, level, pos, node FROM inner_tree
                  UNION ALL SELECT s.grp, s.height + t.level, t.pos, t.node FROM subroots s, top_tree t WHERE t.total > 1 OR t.level > 0),
        walk(doc_id, grp, level, spot, value, siblings) AS (
            SELECT doc_id, grp, 0, pos, changed, '' FROM leaves
            UNION ALL
            SELECT w.doc_id, w.grp, w.level + 1, w.place // 2,
                   sha256(CASE WHEN w.place % 2 = 1 THEN coalesce(n.node, '') || w.value ELSE w.value || coalesce(n.node, '') END),
                   w.siblings || coalesce(n.node, '')
            FROM (SELECT walk.doc_id, walk.grp, walk.level, walk.value, walk.siblings, s.height + tops.height AS ends,
                         CASE WHEN walk.level = s.height THEN s.pos ELSE walk.spot END AS place
                  FROM walk JOIN subroots s USING (grp), (SELECT max(level) AS height FROM top_tree) tops) w
            LEFT JOIN nodes n ON n.grp = w.grp AND n.level = w.level AND n.pos = xor(w.place, 1)
                              AND NOT (w.level = 0 AND w.ends = 0)
            WHERE w.level < w.ends),
        ends AS (SELECT doc_id, grp, arg_max(value, level) AS folded_root, arg_max(siblings, level) AS siblings FROM walk GROUP BY doc_id, grp)
        SELECT l.doc_id, l.leaf, s.subroot, r.node AS root, sha256(e.siblings) AS proof_sha256, e.folded_root, e.folded_root = r.node AS verified
        FROM leaves l JOIN ends e USING (doc_id, grp) JOIN subroots s USING (grp), top_tree r WHERE r.total = 1""",
    "op12_chat_formatting": f"""
        WITH turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
                       UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok'))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum({len(chat.HEAD) + len(chat.SEPARATOR) + len(chat.END)} + length(replace({_sql_escaped('role')}, ':', '\\:'))
                   + length({_sql_escaped('text')}))::BIGINT AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op13_spelling_variants": f"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
                 FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)),
        each AS (SELECT doc_id || ':' || run AS name, run, count(*) AS n FROM runs GROUP BY ALL HAVING length(run) >= 7),
        hashed AS (SELECT run, n, {_crc32("name")} AS h FROM each, crc),
        words AS (SELECT word, sum(n)::BIGINT AS n
                  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
                        FROM hashed)
                  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
                FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
        pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
                  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
                  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
        best AS (SELECT word, count(*) AS n_near, max(near_n) AS near_n FROM pairs GROUP BY word),
        forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n,
                         CASE WHEN b.near_n >= 10 * w.n THEN (SELECT min(near) FROM pairs p WHERE p.word = w.word AND p.near_n = b.near_n) END AS form
                  FROM words w LEFT JOIN best b USING (word)),
        chain(word, root) AS (SELECT word, word FROM forms
                              UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
        SELECT word, form, root, n, n_near, form_n
        FROM (SELECT f.*, e.root FROM forms f JOIN (SELECT c.word, c.root FROM chain c JOIN forms g ON g.word = c.root WHERE g.form IS NULL) e USING (word))""",
    "op9_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
                          AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
}
