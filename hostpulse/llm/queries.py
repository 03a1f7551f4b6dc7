"""The registered queries over these operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostpulse.llm.decontaminate import find_leaks
from hostpulse.llm.lines import dedup_lines
from hostpulse.llm.merkle import document_manifest
from hostpulse.llm.negatives import hard_negatives
from hostpulse.llm.pieces import encode_pieces
from hostpulse.llm.quality import score_quality
from hostpulse.llm.secrets import BASE, scan_secrets
from hostpulse.llm.simhash import simhash_groups
from hostpulse.llm.tokens import checked_ids, token_files
from hostpulse.llm.toxicity import fit_toxicity, score_toxicity
from hostpulse.llm.urls import ORDER, Rule, judge_urls
from hostpulse.llm.vectors import near_vectors
from hostpulse.llm.warc import archive_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spans(findings: str) -> F.Column:
    return F.array_join(
        F.transform(
            F.col(findings), lambda span: F.concat_ws(":", span.kind, span.start, span.end)
        ),
        ",",
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality of every document."""
    scored = score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash_groups(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


URL_RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url, by rule or by the character models."""
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).drop("score")


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which it holds a passage."""
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity and grade of every document."""
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, spans of all kinds."""
    found = scan_secrets(_table(spark, sf_dir, "documents")).withColumn(
        "base", F.filter("findings", lambda span: span.kind.isin(*BASE))
    )
    return found.select(
        "doc_id",
        *(
            F.expr(f"bigint(size(filter(findings, span -> span.kind = '{kind}')))").alias(f"n_{kind}")
            for kind in BASE
        ),
        F.sha2(_spans("base"), 256).alias("base_sha256"),
        _spans("findings").alias("spans"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines it shares with a smaller doc_id, as a digest."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and what they decode to, as digests."""
    return encode_pieces(
        _table(spark, sf_dir, "documents"),
        "piece_bpe_32k.model",
        ("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives written for it."""
    return archive_pages(_table(spark, sf_dir, "pages"), payloads=False).drop("payload")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether it still verifies after tampering."""
    siblings = F.transform("path", lambda step: F.concat(step.left, step.right))
    return document_manifest(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after some labels have moved on by one."""
    moved = F.when(F.expr("vec_id % 7 = 0"), (F.col("label").cast("bigint") + 1) % 10)
    vectors = _table(spark, sf_dir, "embeddings").withColumn(
        "label", F.coalesce(moved, F.col("label").cast("bigint"))
    )
    return hard_negatives(vectors, F.expr("vec_id % 100 = 0"))


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, number and checksum of ids, as read back from the files."""
    docs = _table(spark, sf_dir, "documents")
    return checked_ids(token_files(docs, "word_bpe_49k.json", end_id=1))


def _op3_sql() -> str:
    rules = ", ".join(f"('{rule.host}', '{rule.path}', '{rule.verdict}')" for rule in URL_RULES)
    levels = []
    for order in range(ORDER + 1):
        counted = f"""
          SELECT tail, substr(tail, 1, {order}) AS context, substr(tail, 2, {order}) AS shorter,
            sum(allow) AS allow, sum(block) AS block
          FROM (SELECT right(gram, {order + 1}) AS tail, allow, block FROM counts) GROUP BY tail
        """
        low = f"JOIN level{order - 1} AS low ON low.tail = c.shorter" if order else ""
        parts = []
        for kind in ("allow", "block"):
            below = f"low.{kind}_p" if order else "(1.0 / count(*) OVER w)::double"
            parts.append(f"""
              CASE WHEN sum({kind}) OVER w > 0 THEN
                ({kind} + count(*) FILTER ({kind} > 0) OVER w * {below})
                  / (sum({kind}) OVER w + count(*) FILTER ({kind} > 0) OVER w)
              ELSE {below} END AS {kind}_p""")
        levels.append(f"""level{order} AS (
          SELECT c.tail, {", ".join(parts)} FROM ({counted}) c {low} WINDOW w AS (PARTITION BY c.context)
        )""")
    return rf"""
    WITH rests AS (
      SELECT page_id, coalesce(url, '') AS url,
        CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
      FROM pages
    ), addresses AS (
      SELECT page_id, url,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
      FROM rests
    ), rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}
    ), ruled AS (
      SELECT page_id, url, host, path,
        arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict,
        CAST('0x' || substr(md5(url), 1, 6) AS BIGINT) % 5 AS part
      FROM addresses LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
        AND starts_with(path, rule_path)
      GROUP BY page_id, url, host, path
    ), padded AS (
      SELECT *, repeat(chr(2), {ORDER}) || host || path || chr(3) AS text FROM ruled
    ), grams AS (
      SELECT page_id, verdict, part, substr(text, place, {ORDER + 1}) AS gram
      FROM (SELECT *, unnest(range(1, length(text) - {ORDER} + 1)) AS place FROM padded)
    ), counts AS (
      SELECT gram, count(*) FILTER (part > 0 AND verdict = 'allow') AS allow,
        count(*) FILTER (part > 0 AND verdict = 'block') AS block
      FROM grams GROUP BY gram
    ), {", ".join(levels)}, scores AS (
      SELECT page_id, round(avg(ln(allow_p / block_p)), 9) AS score
      FROM grams JOIN level{ORDER} ON tail = gram GROUP BY page_id
    ), bins AS (
      SELECT CAST(greatest(least(floor(score * 100), 2000), -2000) AS BIGINT) AS bin,
        count(*) FILTER (verdict = 'allow') AS allow, count(*) FILTER (verdict = 'block') AS block
      FROM scores JOIN ruled USING (page_id) WHERE part = 0 AND verdict IS NOT NULL GROUP BY bin
    ), gains AS (
      SELECT bin, coalesce(sum(block) OVER below, 0) / sum(block) OVER ()
        - coalesce(sum(allow) OVER below, 0) / sum(allow) OVER () AS gain,
        coalesce(lag(bin) OVER (ORDER BY bin) + 1, bin) AS gap
      FROM bins WHERE (SELECT sum(allow) > 0 AND sum(block) > 0 FROM bins)
      WINDOW below AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), cut AS (
      SELECT coalesce((SELECT (bin + gap) / 200.0 FROM gains ORDER BY gain DESC, bin LIMIT 1), 0) AS cut
    )
    SELECT page_id, host, path, rule,
      coalesce(verdict, CASE WHEN score >= cut THEN 'allow' ELSE 'block' END) AS verdict
    FROM ruled JOIN scores USING (page_id), cut
    """


_OP4_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT one.vec_id AS one, two.vec_id AS two FROM usable one JOIN usable two
  ON one.vec_id <> two.vec_id AND list_cosine_similarity(one.vector, two.vector) >= 0.9
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT reached.vec_id, links.two FROM reached JOIN links ON links.one = reached.other
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE one = e.vec_id) AS n_links,
  min(other) AS component_id, e.vec_id = min(other) AS kept
FROM embeddings e JOIN reached USING (vec_id) GROUP BY e.vec_id
"""

_OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, coalesce(k.doc_id <> s.keeper, false) AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP10_SQL = """
WITH facts AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size
  FROM pages
), judged AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS low FROM facts
)
SELECT page_id, cast(size AS bigint) AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN size >= 100 AND page_id > low THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 100 AND page_id > low THEN low END AS refers_to
FROM judged
"""

def _field(value: str) -> str:
    value = f"cast({value} AS varchar)"
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


def _op11_sql() -> str:
    head = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
    plain, altered = _field("text"), _field("replace(text, chr(10), '')")
    # The lowest bit of a CRC-32, by its bits: DuckDB has no function for it.
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = f"""
      list_reduce(list_transform(string_split(cast(doc_id AS varchar), ''), lambda s: ord(s)::bigint),
        lambda crc, byte: list_reduce(
          [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, ignored: {bit}), 4294967295::bigint)
    """
    levels = """
      SELECT {tree} AS tree, 0::bigint AS level, row_number() OVER (PARTITION BY {tree} ORDER BY {order}) - 1 AS place,
        count(*) OVER (PARTITION BY {tree}) AS n, {digest} AS digest FROM {table}
      UNION ALL
      SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
      FROM {name} WHERE n > 1 GROUP BY tree, level, place // 3, n
    """
    steps = """
      SELECT {columns}, {start} AS tree, 0::bigint AS level, {place} AS place, {n} AS n, {proof} AS proof,
        {folded} AS folded FROM {table}
      UNION ALL
      SELECT {carried}, p.tree, p.level + 1, p.place // 3, (p.n + 2) // 3,
        p.proof || coalesce(
          list_aggregate(list_filter(run, lambda x, i: i <> p.place % 3 + 1), 'string_agg', ''), ''),
        sha256(list_aggregate(list_transform(run, lambda x, i: CASE WHEN i = p.place % 3 + 1 THEN p.folded ELSE x END),
          'string_agg', ''))
      FROM {name} p JOIN {runs} r ON p.tree IS NOT DISTINCT FROM r.tree AND p.level = r.level AND p.place // 3 = r.run_no
      WHERE p.n > 1
    """
    runs = """SELECT tree, level, place // 3 AS run_no, list(digest ORDER BY place) AS run
      FROM {nodes} GROUP BY tree, level, place // 3"""
    low = levels.format(tree="source", order="doc_id NULLS FIRST, leaf", digest="leaf", table="leaves", name="nodes")
    high = levels.format(tree="1", order="tree NULLS FIRST", digest="digest", table="subroots", name="tops")
    up = steps.format(
        columns="doc_id, leaf, crc",
        carried="p.doc_id, p.leaf, p.crc",
        start="source",
        place="place",
        n="n",
        proof="''",
        folded="CASE WHEN crc % 2 = 0 THEN altered ELSE leaf END",
        table="placed",
        name="climb",
        runs="runs",
    )
    over = steps.format(
        columns="doc_id, leaf, subroot",
        carried="p.doc_id, p.leaf, p.subroot",
        start="1",
        place="place",
        n="n",
        proof="proof",
        folded="folded",
        table="arrived",
        name="top_climb",
        runs="top_runs",
    )
    return f"""
    WITH RECURSIVE leaves AS (
      SELECT doc_id, source, sha256({head} || {plain}) AS leaf, sha256({head} || {altered}) AS altered,
        xor({crc}, 4294967295) AS crc
      FROM documents
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY source) AS n FROM leaves
    ), nodes AS ({low}), subroots AS (SELECT tree, digest FROM nodes WHERE n = 1
    ), tops AS ({high}), runs AS ({runs.format(nodes="nodes")}), top_runs AS ({runs.format(nodes="tops")}
    ), climb AS ({up}), arrived AS (
      SELECT doc_id, leaf, s.digest AS subroot, proof, folded, s.place, s.n
      FROM climb c JOIN (SELECT *, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place,
        count(*) OVER () AS n FROM subroots) s ON c.tree IS NOT DISTINCT FROM s.tree
      WHERE c.n = 1
    ), top_climb AS ({over})
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root,
      folded = root AS verified
    FROM (SELECT *, (SELECT max(digest) FROM tops WHERE n = 1) AS root FROM top_climb) WHERE n = 1
    """


_OP12_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::bigint + 1) % 10 ELSE label END AS label,
    list_transform(embedding::double[], lambda x: floor(256 * x)) AS whole
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    cast(list_inner_product(a.whole, b.whole) AS bigint) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, cast(row_number() OVER w AS integer) AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

QUERIES = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_urls": op3_urls,
    "op4_vectors": op4_vectors,
    "op5_decontaminate": op5_decontaminate,
    "op6_toxicity": op6_toxicity,
    "op7_secrets": op7_secrets,
    "op8_line_dedup": op8_line_dedup,
    "op9_pieces": op9_pieces,
    "op10_warc": op10_warc,
    "op11_merkle": op11_merkle,
    "op12_negatives": op12_negatives,
    "op13_tokens": op13_tokens,
}

ORACLES = {
    "op3_urls": _op3_sql(),
    "op4_vectors": _OP4_SQL,
    "op8_line_dedup": _OP8_SQL,
    "op10_warc": _OP10_SQL,
    "op11_merkle": _op11_sql(),
    "op12_negatives": _OP12_SQL,
}
