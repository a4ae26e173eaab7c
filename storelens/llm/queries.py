"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from storelens.llm import byte_bpe, collocations, language_model, mixing, near_dedup, prefix_trie, quality_classifier, repeats, secrets, spotsigs, substring_dedup, token_counts, toxicity
from storelens.llm.common import documents
from storelens.llm.registry import query
from storelens.session import configure


@query("op1_mixing")
def _(spark, sf_dir):
    return mixing.plan(documents(spark, sf_dir)).drop("source")


_OP2_SQL = r"""WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
  win AS (SELECT doc_id, p, sha256(array_to_string(words[p:p + 49], ' ')) AS h
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM w WHERE len(words) >= 50)),
  smallest AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h),
  gone AS (SELECT DISTINCT doc_id, p + k AS i FROM (SELECT win.doc_id, win.p, unnest(range(0, 50)) AS k
    FROM win JOIN smallest USING (h) WHERE win.doc_id > smallest.lo)),
  each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
  kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""


@query("op2_substring_dedup", _OP2_SQL)
def _(spark, sf_dir):
    cut = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_spotsigs")
def _(spark, sf_dir):
    return spotsigs.compare_with_edits(documents(spark, sf_dir))


@query("op4_token_counts")
def _(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_secret_scan")
def _(spark, sf_dir):
    count = [secrets.of_kind("base", k).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return secrets.scan(documents(spark, sf_dir)).select(
        "doc_id", *count, F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"), secrets.joined(F.col("found")).alias("spans")
    )


@query("op6_near_dedup")
def _(spark, sf_dir):
    return near_dedup.near_duplicates(documents(spark, sf_dir))


@query("op7_byte_bpe")
def _(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded.drop("text"), ranks).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_language_model")
def _(spark, sf_dir):
    held_out = toxicity.id_fold(10) == 0
    scored = language_model.score(documents(spark, sf_dir), ~held_out, public_tokenizers.path("piece_bpe_32k.model"))
    return scored.withColumn("held_out", F.coalesce(held_out, F.lit(True)))


@query("op10_quality_rules")
def _(spark, sf_dir):
    return repeats.quality(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


@query("op8_toxicity")
def _(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = toxicity.id_fold(4) == 2
    model = toxicity.learn(docs, labels, ~held_out)
    # a row without an id is never learnt from
    return toxicity.score(docs, model).select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score", "predicted")


_OP11_SQL = r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
  totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang),
  runs AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT lang, w, unnest(range(1, 6)) AS k FROM words) WHERE len(w) >= k),
  f AS (SELECT lang, k, w[i:i + k - 1] AS p, CAST(count(*) AS HUGEINT) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
  cuts AS (SELECT lang, k, p, f, unnest(range(1, k)) AS cut FROM f WHERE k >= 2),
  valued AS (SELECT c.lang, c.p, c.cut, c.f AS a, l.f AS l, r.f AS r, t.n, (1000 * c.f * t.n) // (l.f * r.f) AS score FROM cuts c JOIN totals t USING (lang)
    JOIN f l ON l.lang = c.lang AND l.p = c.p[1:c.cut] JOIN f r ON r.lang = c.lang AND r.p = c.p[c.cut + 1:]),
  lowest AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
  inner_ AS (SELECT lang, p[s:s + m - 1] AS p, max(f) AS longer FROM (SELECT lang, p, f, k, m, unnest(range(1, k - m + 2)) AS s
    FROM (SELECT lang, p, f, k, unnest(range(2, k)) AS m FROM f WHERE k >= 3)) GROUP BY ALL),
  free AS (SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM lowest b LEFT JOIN inner_ i ON i.lang = b.lang AND i.p = b.p WHERE i.longer IS NULL OR i.longer < b.a)
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
    CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM free QUALIFY rank <= 2000"""


@query("op11_collocations", _OP11_SQL)
def _(spark, sf_dir):
    return collocations.collocations(documents(spark, sf_dir))


@query("op12_quality_classifier")
def _(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = toxicity.id_fold(5) == 0
    model = quality_classifier.learn(docs, labels, ~held_out)
    return quality_classifier.score(docs, model).select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score", "predicted")


# crc32 bit by bit: the low two bits of the complement are crc32 % 4
_OP13_SQL = r"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
  own AS (SELECT conv_id, list({'v': sha256(concat(len(role), ':', role, text)), 'w': len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))}
      ORDER BY turn NULLS FIRST, role, sha256(text)) AS t FROM turns GROUP BY conv_id),
  headed AS (SELECT conv_id, t, 3 - list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(CAST(conv_id AS VARCHAR)) + 1),
      lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT))),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) % 4 AS h FROM own),
  rebuilt AS (SELECT o.conv_id, list_concat(coalesce(b.t[1:o.h], []), o.t[o.h + 1:]) AS t FROM headed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
  paths AS (SELECT conv_id, t[1:d] AS p, d, len(t) AS n FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)),
  nodes AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
      sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256 FROM paths GROUP BY p, d),
  kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
  full_ AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (p)),
  below AS (SELECT p[1:k] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * coalesce(p[d].w, 0)) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM full_) GROUP BY 1)
  SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
    CAST(b.saved AS BIGINT) AS saved_tokens, f.ends_sha256
  FROM full_ f JOIN below b USING (p) LEFT JOIN nodes u ON f.d > 0 AND u.p = f.p[1:f.d - 1]"""


@query("op13_prefix_trie", _OP13_SQL)
def _(spark, sf_dir):
    return prefix_trie.trie(configure(spark).read.parquet(f"{sf_dir}/conversations.parquet"))
