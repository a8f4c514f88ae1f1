"""Expected results of the text operators in DuckDB SQL, where SQL can express them."""

from __future__ import annotations


def gnat_codes(rounds: int = 4) -> str:
    """Codebooks by full comparison: one nearest-entry query a round."""

    def nearest(r: int) -> str:
        distance = "(list_dot_product(p.x, p.x) + list_dot_product(c.x, c.x) - 2 * list_dot_product(p.x, c.x))::BIGINT"
        return f"""a{r} AS MATERIALIZED (
                SELECT vec_id, p.part, any_value(p.x) AS x, min({{'d': {distance}, 'entry': c.entry}}) AS best
                FROM p JOIN c{r} c ON p.part = c.part GROUP BY vec_id, p.part
            )"""

    def moved(r: int) -> str:
        return f"""m{r} AS (
                SELECT part, entry, list(mean ORDER BY place) AS x FROM (
                    SELECT part, best.entry AS entry, place, floor(sum(x[place]) / count(*)) AS mean
                    FROM a{r}, unnest(range(1, len(x) + 1)) t(place) GROUP BY ALL
                ) GROUP BY part, entry
            ), c{r + 1} AS MATERIALIZED (
                SELECT part, entry, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (part, entry)
            )"""

    steps = ", ".join(f"{nearest(r)}, {moved(r)}" for r in range(rounds))
    return f"""
            WITH v AS (
                SELECT vec_id, label, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
                WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            ), p AS MATERIALIZED (
                SELECT vec_id, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS x FROM v, range(4) t(part)
            ), c0 AS (
                SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, x FROM p
                QUALIFY dense_rank() OVER (ORDER BY vec_id) <= 256
            ), {steps}, {nearest(rounds)}, coded AS (
                SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
                FROM a{rounds} GROUP BY vec_id
            ), books AS (
                SELECT sha256(string_agg(x[place]::BIGINT::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256
                FROM c{rounds}, unnest(range(1, len(x) + 1)) t(place)
            )
            SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256, label
            FROM coded JOIN v USING (vec_id), books
        """


def oracles() -> dict[str, str]:
    return {
        "op6_exact_dedup": r"""
            WITH t AS (
                SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g') AS content FROM documents
            ), g AS (
                SELECT content, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY content
            )
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
            FROM t JOIN g USING (content)
        """,
        "op9_nn_descent": """
            WITH RECURSIVE v AS (
                SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            ), links AS (
                SELECT a.vec_id AS one, b.vec_id AS other
                FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
                WHERE list_cosine_similarity(a.e, b.e) >= 0.93
            ), reach(one, other) AS (
                SELECT vec_id, vec_id FROM v
                UNION
                SELECT r.one, l.other FROM reach r JOIN links l ON r.other = l.one
            ), counted AS (
                SELECT one, count(*) AS n FROM links GROUP BY one
            )
            SELECT r.one AS vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(r.other) AS component_id,
                   min(r.other) = r.one AS kept
            FROM reach r LEFT JOIN counted c ON c.one = r.one GROUP BY r.one
        """,
        "op10_minhash_near_dedup": r"""
            WITH RECURSIVE t AS (
                SELECT doc_id, regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+'
                ) AS w FROM documents
            ), s AS MATERIALIZED (
                SELECT DISTINCT doc_id, shingle FROM (
                    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS shingle
                    FROM t)
            ), n AS MATERIALIZED (
                SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
            ), met AS (
                SELECT a.doc_id AS one, b.doc_id AS other, count(*) AS shared
                FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
            ), links AS MATERIALIZED (
                SELECT one, other FROM met JOIN n x ON x.doc_id = one JOIN n y ON y.doc_id = other
                WHERE 100 * shared >= 85 * (x.n + y.n - shared)
            ), reach(one, other) AS (
                SELECT doc_id, doc_id FROM documents
                UNION
                SELECT r.one, l.other FROM reach r JOIN links l ON r.other = l.one
            )
            SELECT r.one AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id,
                   min(r.other) = r.one AS kept
            FROM reach r LEFT JOIN n ON n.doc_id = r.one GROUP BY r.one
        """,
        "op11_gnat_codes": gnat_codes(),
        "op12_hard_negatives": """
            WITH v AS (
                SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                       [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
                FROM embeddings
                WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            ), met AS (
                SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                       list_dot_product(a.v, b.v)::BIGINT AS score
                FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
            ), positives AS (
                SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM met WHERE same
                QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
            )
            SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
                   (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank
            FROM positives JOIN met USING (anchor_id)
            WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
            QUALIFY rank <= 5
        """,
    }
