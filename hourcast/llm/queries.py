"""Registered queries ``opN_<name>``: every operator over its whole table, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import (bpe, chat, fill_in_middle, knn, quality, reshard, simhash, spelling, substring,
                          token_store, url_filter)
from hourcast.llm.decontaminate import contamination
from hourcast.llm.language_model import lm_scores

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"
OLD_SHARDS, SHARDS = 20, 24
NEIGHBOURS = 20
#: The rules of the URL filter, in its contract's order.
URL_RULES = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
             url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"),
             url_filter.Rule("block", "net", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and read back from its rendering."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    out = chat.parse(chat.format_events(chat.message_events(rows.unionByName(own))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top 20 by inner product of floor(64 x) for every vec_id divisible by 20."""
    return knn.top_k(spark, _table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, NEIGHBOURS,
                     component=lambda x: F.floor(x * 64))


def op3_flow_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from 20 hashed shards to 24 of near equal bytes, by minimum-cost flow."""
    docs = _table(spark, sf_dir, "documents")
    old = F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS))
    text = F.coalesce("text", F.lit(""))
    return reshard.reshard(spark, docs, old, OLD_SHARDS, SHARDS).select(
        "doc_id", (F.octet_length(text) + reshard.ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with at least 0.8 of the item's five-word shingles."""
    return contamination(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; links at 4 or fewer differing bits."""
    return simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text; learned from labels outside the held-out quarter."""
    docs = _table(spark, sf_dir, "documents")
    trees = quality.fit(spark, docs, _table(spark, sf_dir, "labels"), quality.id_remainder("doc_id", 4) != 2)
    return quality.score(spark, docs.select("doc_id", "text"), trees).select(
        "doc_id", (quality.id_remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts' token ids written to patched frame-of-reference files and read back."""
    folder = token_store.store_folder(spark)
    token_store.write(spark, _table(spark, sf_dir, "documents"), folder,
                      public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read(spark, folder)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of every whole text; learned outside the held-out fifth."""
    held_out = quality.id_remainder("doc_id", 5) == 1
    out = lm_scores(spark, _table(spark, sf_dir, "documents"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text and the bytes they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(bpe.roundtrip(spark, docs, path))


def bpe_digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside windows of 35 words that occur more than once."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(spark, docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_variants(spark, spelling.vocabulary(docs))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict, by the longest rule or else by its host's trust and distrust."""
    return url_filter.url_verdicts(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text put out in its form, and rebuilt from output and form, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return fill_in_middle.transform(spark, docs, restored=True).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output").alias("output_sha256"),
        sha("restored").alias("restored_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline of ``corpus_pipeline.py``."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_chat_format, op2_topk_search, op3_flow_reshard, op4_decontamination, op5_simhash, op6_quality,
    op7_token_store, op8_lm_score, op9_bpe, op10_substring_dedup, op11_spelling_variants, op12_url_filter,
    op13_fill_in_middle, pipeline)}

_SPACES = "[\\x20\\x09-\\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# crc32 by its table of byte steps, over the bytes of an ASCII id, a colon and a word
# whose letters stand for one byte below U+0080 and for two from U+00C0 on
_CRC32 = """
        WITH RECURSIVE steps(b, c, k) AS (
            SELECT range, range, 0 FROM range(256)
            UNION ALL
            SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8),
        crc_table AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),"""


def _rule_sql(column: str) -> str:
    """The longest fitting rule's name or verdict, as nested conditions."""
    order = sorted(URL_RULES, key=lambda r: -len(r.host + r.path))
    value = {"rule": lambda r: r.host + r.path, "verdict": lambda r: r.verdict}[column]
    return "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{value(r)}'"
        for r in order) + " END"


def _url_sql() -> str:
    """Rules, host graph and the rounds of both vectors in integers, as ``url_filter`` has them."""
    U = url_filter
    rounds = "".join(f"""
        m{i + 1} AS (
            SELECT node, sum(mass) AS mass FROM (
                SELECT s.dest AS node, CAST(floor(m.mass * {U.DAMPING}::DOUBLE * s.share) AS BIGINT) AS mass
                FROM m{i} m JOIN shares s ON s.node = m.node
                UNION ALL SELECT node, CAST(floor(mass * (1 - {U.DAMPING}::DOUBLE)) AS BIGINT) FROM m0)
            GROUP BY node),""" for i in range(U.ROUNDS))
    return f"""
        WITH located AS (
            SELECT page_id, html, {_LOWER.format("coalesce(regexp_extract(url, '^[\\s\\S]*?://([^/?#]*)', 1), '')")} AS host,
                   coalesce(regexp_extract(url, '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        judged AS (SELECT *, {_rule_sql("rule")} AS rule, {_rule_sql("verdict")} AS verdict FROM located),
        seen AS (
            SELECT DISTINCT page_row, src, dst, verdict FROM (
                SELECT row_number() OVER () AS page_row, host AS src, verdict, unnest(list_prepend(host, list_transform(
                    regexp_extract_all(coalesce(html, ''),
                        '(?i)(?:href|src)\\s*=\\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\\s<>]+)', 1),
                    lambda x: {_LOWER.format("x")}))) AS dst FROM judged WHERE host <> '')),
        links AS (SELECT src, dst, count(*) AS weight, count(*) FILTER (src = dst AND verdict = 'allow') AS allowed,
                         count(*) FILTER (src = dst AND verdict = 'block') AS blocked FROM seen GROUP BY ALL),
        labels_ AS (SELECT src, weight, string_split(src, '.') AS l FROM links WHERE src = dst),
        below AS (
            SELECT d, sum(weight) AS weight FROM (
                SELECT weight, array_to_string(l[i:], '.') AS d FROM (
                    SELECT weight, l, unnest(CASE WHEN len(l) > 2 AND NOT regexp_full_match(l[-1], '[0-9]*')
                                             THEN range(1, len(l)) ELSE [1] END) AS i FROM labels_))
            GROUP BY d),
        up AS (SELECT d, array_to_string(string_split(d, '.')[2:], '.') AS above, weight FROM below
               WHERE len(string_split(d, '.')) > 2 AND NOT regexp_full_match(string_split(d, '.')[-1], '[0-9]*')),
        across_ AS (
            SELECT src, dst, weight FROM links UNION ALL SELECT d, above, weight FROM up
            UNION ALL SELECT above, d, weight FROM up),
        hosts AS (SELECT DISTINCT unnest([src, dst]) AS host FROM across_),
        nodes AS (SELECT host, coalesce(weight, 0) AS n_pages, coalesce(allowed, 0) AS allowed, coalesce(blocked, 0) AS blocked
                  FROM hosts LEFT JOIN links ON src = host AND dst = host),
        edges AS (
            SELECT src, dst, sum(weight) AS weight FROM (
                FROM across_ UNION ALL SELECT host, host, 1 FROM nodes WHERE n_pages = 0) GROUP BY ALL),
        moves AS (SELECT '>' || src AS node, '>' || dst AS dest, weight FROM edges
                  UNION ALL SELECT '<' || dst, '<' || src, weight FROM edges),
        shares AS (SELECT node, dest, CAST(weight AS DOUBLE) / CAST(sum(weight) OVER (PARTITION BY node) AS DOUBLE) AS share
                   FROM moves),
        m0 AS (SELECT '>' || host AS node, allowed * {U.UNIT} AS mass FROM nodes WHERE allowed > 0
               UNION ALL SELECT '<' || host, blocked * {U.UNIT} FROM nodes WHERE blocked > 0),{rounds}
        scored AS (
            SELECT host, n_pages, coalesce(t.mass, 0) AS trust, coalesce(d.mass, 0) AS distrust FROM nodes
            LEFT JOIN m{U.ROUNDS} t ON t.node = '>' || host LEFT JOIN m{U.ROUNDS} d ON d.node = '<' || host)
        SELECT page_id, host, path, rule,
               coalesce(verdict, CASE WHEN distrust - trust > floor(n_pages * {U.MARGIN * U.UNIT}::DOUBLE) THEN 'block' END,
                        'allow') AS verdict
        FROM judged LEFT JOIN scored USING (host)"""


ORACLE_SQL: dict[str, str] = {
    # the rendering's length: header, text and end of every turn, and one more character
    # for each "<", backslashes, "|" inside a role or text
    "op1_chat_format": f"""
        WITH rows_ AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
            UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                               FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(24 + length(role) + length(text)
                        + len(regexp_extract_all(text, '<\\\\*\\|'))
                        + len(regexp_extract_all(role, '<\\\\*\\|'))
                        + 4 * (length(role) - length(replace(role, chr(10), '')))) AS BIGINT) AS formatted_chars
        FROM rows_ GROUP BY conv_id""",
    "op2_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 20""",
    "op4_decontamination": f"""
        WITH words_ AS (
            SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACES}'),
                       lambda x: x <> '') AS w FROM documents
            UNION ALL
            SELECT 'i', item_id, list_filter(regexp_split_to_array(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACES}'),
                       lambda x: x <> '') FROM benchmark),
        lengths AS (SELECT DISTINCT least(5, len(w)) AS k FROM words_ WHERE side = 'i' AND len(w) > 0),
        items AS (
            SELECT DISTINCT id, k, list_aggregate(w[p:p + k - 1], 'string_agg', ' ') AS s
            FROM (SELECT id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p
                  FROM words_ WHERE side = 'i' AND len(w) > 0)),
        docs AS (
            SELECT DISTINCT id, k, list_aggregate(w[p:p + k - 1], 'string_agg', ' ') AS s
            FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS p
                  FROM words_ JOIN lengths ON side = 'd' AND len(w) >= k)),
        sizes AS (SELECT id, count(*) AS n FROM items GROUP BY id)
        SELECT docs.id AS doc_id, items.id AS item_id, any_value(n) AS n_shingles, count(*) AS n_shared,
               count(*) / any_value(n) AS containment
        FROM items JOIN docs USING (k, s) JOIN sizes ON sizes.id = items.id
        GROUP BY docs.id, items.id HAVING count(*) >= 0.8 * any_value(n)""",
    "op10_substring_dedup": f"""
        WITH w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}'), lambda x: x <> '') AS w
            FROM documents),
        wins AS (
            SELECT doc_id, p, md5(list_aggregate(w[p:p + 34], 'string_agg', ' ')) AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM w WHERE len(w) >= 35)),
        rep AS (SELECT doc_id, p FROM wins WHERE s IN (SELECT s FROM wins GROUP BY s HAVING count(*) > 1)),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM rep),
        each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w),
        kept AS (
            SELECT each.doc_id, count(gone.i) AS n_removed,
                   coalesce(string_agg(x, ' ' ORDER BY each.i) FILTER (gone.i IS NULL), '') AS t
            FROM each LEFT JOIN gone ON each.doc_id = gone.doc_id AND each.i = gone.i GROUP BY each.doc_id)
        SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op11_spelling_variants": f"""{_CRC32}
        runs AS (
            SELECT doc_id, {_LOWER.format("run")} AS w, count(*) AS n FROM (
                SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{7,}}')) AS run FROM documents)
            GROUP BY ALL),
        coded AS (
            SELECT w, n, list_concat(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':', ''), lambda x: ord(x)),
                   flatten(list_transform(string_split(w, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)]
                                          ELSE [192 + ord(x) // 64, 128 + ord(x) % 64] END))) AS b FROM runs),
        hashed AS (
            SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(b, lambda x: CAST(x AS BIGINT))),
                       lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS h
            FROM coded, crc_table),
        vocab AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
                SELECT n, CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word
                FROM hashed)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS v
                 FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
        near AS (
            SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b
                ON a.v = b.v AND a.i = b.i AND a.word <> b.word AND length(a.word) = length(b.word)
            UNION SELECT DISTINCT a.word, b.word, b.n FROM less a JOIN vocab b ON a.v = b.word
            UNION SELECT DISTINCT b.word, a.word, a.n FROM less a JOIN vocab b ON a.v = b.word),
        best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
                 FROM near GROUP BY word),
        forms AS (SELECT word, CASE WHEN other_n >= {spelling.RATIO} * n THEN other END AS form, n,
                         coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {spelling.RATIO} * n THEN other_n END AS form_n
                  FROM vocab LEFT JOIN best USING (word)),
        walk AS (
            SELECT word, word AS at, form AS next FROM forms
            UNION ALL SELECT walk.word, forms.word, forms.form FROM walk JOIN forms ON forms.word = walk.next)
        SELECT forms.word, form, walk.at AS root, n, n_near, form_n
        FROM forms JOIN walk ON walk.word = forms.word AND walk.next IS NULL""",
    "op12_url_filter": _url_sql(),
    "op13_fill_in_middle": """
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
        drawn AS (
            SELECT *, length(t) AS n, CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
                   CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4 FROM hashed),
        cuts AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                        THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
        parts AS (SELECT *, substr(t, 1, lo) AS p, substr(t, lo + 1, hi - lo) AS m, substr(t, hi + 1) AS s FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256 FROM parts""",
}
