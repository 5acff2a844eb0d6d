"""SQL twins of the operators that SQL can express; brute force over words and pairs, for small tables."""

from tillframe.llm import jaccard
from tillframe.llm.decontaminate import WINDOW
from tillframe.llm.mixing import mixture_sql

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, coalesce({_WORDS}, []) AS w FROM benchmark WHERE item_id IS NOT NULL),
    windows AS MATERIALIZED (
        SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS phrase
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)
    ), places AS (
        SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
    ), hits AS MATERIALIZED (SELECT r, i, n, item FROM places JOIN windows USING (n, phrase)),
    covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
    found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

NEAR_COPIES = f"""
    WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text, coalesce({_WORDS}, []) AS w FROM documents),
    grams AS MATERIALIZED (
        SELECT DISTINCT r, array_to_string(w[i:i + {jaccard.N - 1}], ' ') AS gram
        FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {jaccard.N - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)
    ), sets AS MATERIALIZED (
        SELECT r, count(*) AS n, md5(string_agg(gram, '|' ORDER BY gram)) AS class FROM grams GROUP BY r
        UNION ALL SELECT r, 0, 'text ' || md5(text) FROM d WHERE len(w) = 0 AND text <> ''
    ), linked AS MATERIALIZED (
        SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS common FROM grams x JOIN grams y USING (gram) WHERE x.r <> y.r GROUP BY ALL)
        JOIN sets s ON s.r = a JOIN sets t ON t.r = b
        WHERE common / CAST(s.n + t.n - common AS DOUBLE) >= {jaccard.THRESHOLD}
        UNION SELECT s.r, t.r FROM sets s JOIN sets t USING (class) WHERE s.r <> t.r
    ), reach(r, other) AS (SELECT r, r FROM d UNION SELECT reach.r, b FROM reach JOIN linked ON other = a),
    joined AS (SELECT reach.r, min(d.doc_id) AS class_id FROM reach JOIN d ON d.r = other GROUP BY reach.r),
    copies AS (SELECT class, min(doc_id) AS copy_id FROM sets JOIN d USING (r) GROUP BY class),
    links AS (
        SELECT a AS r, count(*) AS n_links, count(DISTINCT t.class) FILTER (t.class <> s.class) AS n_linked_classes
        FROM linked JOIN sets s ON s.r = a JOIN sets t ON t.r = b GROUP BY a
    )
    SELECT doc_id, coalesce(copy_id, doc_id) AS copy_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_linked_classes, 0) AS n_linked_classes
    FROM d JOIN joined USING (r) LEFT JOIN sets USING (r) LEFT JOIN copies USING (class) LEFT JOIN links USING (r)
"""

_LEVEL = "list_reduce([y, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))"


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    step = _LEVEL.replace("[y,", "[xor(crc, x),")
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda crc, x: {step}), CAST(4294967295 AS BIGINT))"


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


_HEAD = " || ".join(_field(f"CAST({name} AS VARCHAR)") for name in ("doc_id", "source", "lang", "n_chars"))

MERKLE = f"""
    WITH RECURSIVE leaves AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id, coalesce(':' || source, '') AS tree, sha256({_HEAD} || {_field("text")}) AS leaf,
               CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256({_HEAD} || {_field(_LOWER)}) END AS changed
        FROM documents
    ), placed AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size
        FROM leaves
    ), nodes(tree, level, place, size, digest) AS (
        SELECT tree, 0, place, size, leaf FROM placed
        UNION ALL
        SELECT tree, level + 1, place // 16, (min(size) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
        FROM nodes WHERE size > 1 GROUP BY tree, level, place // 16
    ), subroots AS MATERIALIZED (
        SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size FROM nodes WHERE size = 1
    ), over_sources(level, place, size, digest) AS (
        SELECT 0, place, size, digest FROM subroots
        UNION ALL
        SELECT level + 1, place // 16, (min(size) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
        FROM over_sources WHERE size > 1 GROUP BY level, place // 16
    ), runs AS MATERIALIZED (
        SELECT tree, level, place // 16 AS parent, list(digest ORDER BY place) AS run FROM nodes GROUP BY ALL
    ), runs_over AS MATERIALIZED (
        SELECT level, place // 16 AS parent, list(digest ORDER BY place) AS run FROM over_sources GROUP BY ALL
    ), inside(r, tree, level, place, size, own, proof) AS (
        SELECT r, tree, 0, place, size, coalesce(changed, leaf), '' FROM placed
        UNION ALL
        SELECT r, tree, level + 1, place // 16, (size + 15) // 16,
               sha256(array_to_string(run[1:place % 16] || [own] || run[place % 16 + 2:], '')),
               proof || array_to_string(run[1:place % 16] || run[place % 16 + 2:], '')
        FROM (SELECT i.*, u.run FROM inside i JOIN runs u ON u.tree = i.tree AND u.level = i.level AND u.parent = i.place // 16 WHERE i.size > 1)
    ), outside(r, level, place, size, own, proof) AS (
        SELECT r, 0, s.place, s.size, own, proof FROM inside JOIN subroots s USING (tree) WHERE inside.size = 1
        UNION ALL
        SELECT r, level + 1, place // 16, (size + 15) // 16,
               sha256(array_to_string(run[1:place % 16] || [own] || run[place % 16 + 2:], '')),
               proof || array_to_string(run[1:place % 16] || run[place % 16 + 2:], '')
        FROM (SELECT o.*, u.run FROM outside o JOIN runs_over u ON u.level = o.level AND u.parent = o.place // 16 WHERE o.size > 1)
    )
    SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(o.proof) AS proof_sha256, o.own AS folded_root, o.own = t.digest AS verified
    FROM placed p JOIN outside o ON o.r = p.r AND o.size = 1 JOIN subroots s ON s.tree = p.tree, (SELECT digest FROM over_sources WHERE size = 1) t
"""

ORACLE_SQL: dict[str, str] = {
    "op1_mixture_raking": mixture_sql(),
    "op2_benchmark_decontamination": CONTAMINATION,
    "op6_ngram_jaccard_join": NEAR_COPIES,
    "op12_merkle_manifest": MERKLE,
}
