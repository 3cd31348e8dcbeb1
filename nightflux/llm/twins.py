"""SQL twins of the training-data queries that SQL can express."""

from __future__ import annotations

SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def product_codes(parts: int = 4, entries: int = 256, rounds: int = 4, width: int = 16) -> str:
    """Every round written out; all of it integer arithmetic."""
    nearest = f"""SELECT p.row, p.part, arg_min(b.entry, struct_pack(d := d, e := b.entry)) AS entry, min(d) AS d FROM p JOIN %s b USING (part),
        LATERAL (SELECT list_sum([(p.v[i] - b.v[i]) * (p.v[i] - b.v[i]) FOR i IN range(1, {width + 1})])::HUGEINT AS d) GROUP BY p.row, p.part"""
    steps = []
    for k in range(rounds):
        steps.append(f"""a{k} AS MATERIALIZED ({nearest % f'b{k}'}),
        m{k} AS (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
            SELECT part, entry, i, sum(p.v[i])::HUGEINT AS s, count(*) AS n FROM a{k} JOIN p USING (row, part), range(1, {width + 1}) t(i) GROUP BY part, entry, i) GROUP BY part, entry),
        b{k + 1} AS MATERIALIZED (SELECT b{k}.part, b{k}.entry, coalesce(m{k}.v, b{k}.v) AS v FROM b{k} LEFT JOIN m{k} USING (part, entry))""")
    return f"""
    WITH kept AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) AS row FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    p AS MATERIALIZED (SELECT row, part, [floor(1024 * embedding[part * {width} + i]::DOUBLE)::BIGINT FOR i IN range(1, {width + 1})] AS v FROM kept, range({parts}) t(part)),
    b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, v FROM p WHERE row <= {entries}),
    {", ".join(steps)},
    last AS MATERIALIZED ({nearest % f'b{rounds}'}),
    books AS (SELECT sha256(string_agg(x, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM (SELECT part, entry, array_to_string(v, ',') AS x FROM b{rounds})),
    coded AS (SELECT row, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM last GROUP BY row)
    SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (row), books"""


RANKED = rf"""
    WITH words AS (SELECT doc_id, unnest(regexp_extract_all({SMALL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
    tf AS (SELECT doc_id, t, count(*) AS tf FROM words GROUP BY ALL),
    df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
    size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
    whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
    asked AS (SELECT item_id, unnest(regexp_extract_all({SMALL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
    weight AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, whole),
    scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
        FROM asked JOIN weight USING (t) JOIN tf USING (t) JOIN size USING (doc_id), whole GROUP BY ALL)
    SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0) WHERE rank <= 20"""

SQL = {"op11_vector_codes": product_codes(), "op13_ranked_search": RANKED}
