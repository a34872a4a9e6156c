"""The queries of this subpackage, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .best_fit import op13_best_fit
from .bpe import op4_bpe
from .collocations import op11_collocations
from .packing import op9_packing
from .quality_model import op8_quality_model
from .quality_rules import op3_quality_rules
from .secrets import op1_secrets
from .sharding import op5_sharding
from .simhash import op10_simhash
from .tokenfiles import op2_token_files
from .topk import op6_top_k
from .toxicity import op7_toxicity
from .trie import op12_prefix_trie


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_secrets, op2_token_files, op3_quality_rules, op4_bpe, op5_sharding, op6_top_k, op7_toxicity, op8_quality_model, op9_packing, op10_simhash, op11_collocations, op12_prefix_trie, op13_best_fit]
    return {f.__name__: f for f in found}


#: op6 in full.
TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""

#: op12 in full. DuckDB has no crc32, so it is computed bit by bit from the id's digits.
PREFIX_TRIE = """
WITH own AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), rebuilt AS (
  SELECT conv_id, list([role, text] ORDER BY pos) AS seq FROM (
    SELECT i.conv_id, o.pos, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.base AND o.pos <= i.h
    UNION ALL SELECT i.conv_id, o.pos, o.role, o.text FROM ids i JOIN own o USING (conv_id) WHERE o.pos > i.h) GROUP BY 1
), convs AS (
  SELECT conv_id, coalesce(seq, []) AS seq FROM ids LEFT JOIN rebuilt USING (conv_id)
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = size), '') AS ends
  FROM (SELECT conv_id, len(seq) AS size, unnest(range(len(seq) + 1)) AS depth, seq FROM convs), LATERAL (SELECT seq[:depth] AS prefix) GROUP BY 1, 2
), kin AS (
  SELECT c.*, p.conv_id AS parent_conv_id, p.depth AS parent_depth FROM nodes c LEFT JOIN nodes p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.prefix = c.prefix[:c.depth - 1]
), counted AS (
  SELECT k.*, coalesce(n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(prefix[depth][2], '[^\x20\x09-\x0D]+')) END AS saved
  FROM kin k LEFT JOIN (SELECT parent_conv_id AS conv_id, parent_depth AS depth, count(*) AS n FROM kin WHERE depth > 0 GROUP BY 1, 2) USING (conv_id, depth)
), under AS (
  SELECT prefix[:up] AS prefix, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted) GROUP BY 1, 2
)
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN under u USING (prefix, depth)
"""

#: op11 in full, with 128-bit arithmetic.
COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS k))
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT lang, k, phrase, a, c, array_to_string(w[:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)
), best AS (
  SELECT lang, k, phrase, a, arg_min(struct_pack(l := l, r := r, score := score), score * 10 + c) AS b FROM (
    SELECT cuts.*, x.f AS l, y.f AS r, 1000000 * CAST(a AS HUGEINT) * a // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail) GROUP BY ALL
), longer AS (
  SELECT lang, part, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cand WHERE k = 3) GROUP BY ALL
)
SELECT lang, rank, phrase, a, b.l AS l, b.r AS r, n, CAST(b.score AS BIGINT) AS score
FROM (SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY b.score DESC, a DESC, phrase) AS rank
      FROM best LEFT JOIN longer ON longer.lang = best.lang AND part = phrase WHERE most IS NULL OR 100 * most < 50 * a) JOIN n USING (lang)
WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_top_k": TOP_K, "op11_collocations": COLLOCATIONS, "op12_prefix_trie": PREFIX_TRIE}
