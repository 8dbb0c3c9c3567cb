"""The queries of this subpackage, and SQL for those it can express."""

from __future__ import annotations

from tramoggia.llm import answers, boilerplate, encoding, language, mixing, packing, quality, reading, similarity

QUERIES = {
    "p1_found": boilerplate.p1_found,
    "p2_found": quality.p2_found,
    "p2_statistics": quality.p2_statistics,
    "p3_found": language.p3_found,
    "p3_segments": language.p3_segments,
    "p3_documents": language.p3_documents,
    "p4_found": answers.p4_found,
    "p5_found": packing.p5_found,
    "p5_bins": packing.p5_bins,
    "p5_fill": packing.p5_fill,
    "p6_found": similarity.p6_found,
    "p6_classes": similarity.p6_classes,
    "p6_groups": similarity.p6_groups,
    "p7_ids": encoding.p7_ids,
    "p7_round_trip": encoding.p7_round_trip,
    "p8_mix": mixing.p8_mix,
    "p8_report": mixing.p8_report,
    "p9_found": reading.p9_found,
    "p9_levels": reading.p9_levels,
}

_LENGTHS = """
  SELECT example_id, max(CASE WHEN input_ids IS NULL THEN 0 WHEN attention_mask IS NULL THEN len(input_ids)
    ELSE len(input_ids) - len(list_filter(list_slice(attention_mask, 1, len(input_ids)), lambda x: x = 0)) END) AS size
  FROM packed_shards GROUP BY example_id"""

def _shingles(n: int) -> str:
    """Tables r (records), w (their words), sh (distinct runs of n words), c (their number)."""
    run = " || ' ' || ".join(["w[i]", *[f"w[i + {k}]" for k in range(1, n)]])
    return rf"""r AS (SELECT rec_id, text FROM fineweb2_it UNION ALL SELECT rec_id, text FROM wikipedia_it),
w AS (SELECT rec_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM r WHERE text IS NOT NULL),
sh AS (SELECT DISTINCT rec_id, unnest([{run} FOR i IN range(1, len(w) - {n - 2})]) AS s FROM w WHERE len(w) >= {n}),
c AS (SELECT rec_id, count(*) AS n FROM sh GROUP BY 1)"""


_PAIRS = """p AS (SELECT a.rec_id AS rec_a, b.rec_id AS rec_b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.rec_id < b.rec_id GROUP BY 1, 2),
near AS (SELECT rec_a, rec_b, k = x.n AND k = y.n AS same FROM p JOIN c x ON x.rec_id = rec_a JOIN c y ON y.rec_id = rec_b WHERE k * 10 >= {tenths} * (x.n + y.n - k))"""

SQL: dict[str, str] = {
    "p5_found": f"SELECT example_id FROM ({_LENGTHS}) WHERE size > 2048",
    "p6_found": f"WITH {_shingles(3)}, {_PAIRS.format(tenths=6)} SELECT rec_a, rec_b FROM near",
    # Every record with the least record of equal runs, the number of these, and the number of other classes near its own.
    "p6_classes": f"""WITH {_shingles(5)}, {_PAIRS.format(tenths=8)},
both_ AS (SELECT rec_a AS rec_id, rec_b AS other, same FROM near UNION ALL SELECT rec_b, rec_a, same FROM near),
cl AS (SELECT c.rec_id, least(c.rec_id, coalesce(min(b.other), c.rec_id)) AS class_id, count(b.other) + 1 AS copies FROM c LEFT JOIN both_ b ON b.rec_id = c.rec_id AND b.same GROUP BY c.rec_id)
SELECT cl.rec_id, cl.class_id, cl.copies, count(DISTINCT o.class_id) AS links
FROM cl LEFT JOIN both_ b ON b.rec_id = cl.rec_id AND NOT b.same LEFT JOIN cl o ON o.rec_id = b.other GROUP BY ALL""",
    "p6_groups": f"""WITH RECURSIVE {_shingles(3)}, {_PAIRS.format(tenths=6)},
both_ AS (SELECT rec_a AS a, rec_b AS b FROM near UNION ALL SELECT rec_b, rec_a FROM near),
walk(a, b) AS (SELECT rec_id, rec_id FROM c UNION SELECT walk.a, both_.b FROM walk JOIN both_ ON both_.a = walk.b)
SELECT a AS rec_id, min(b) AS group_id FROM walk GROUP BY a""",
    # What any packing must meet: all ids in the bins, none above the capacity, and as many bins as the bound at least.
    "p5_fill": f"""WITH s AS ({_LENGTHS}), t AS (SELECT sum(size) AS ids, ceil(sum(size) / 2048)::BIGINT AS least FROM s)
SELECT least AS bins, ids::BIGINT AS ids, 2048::BIGINT AS fullest, (least * 2048 - ids)::BIGINT AS unused, least AS least_bins, 0::BIGINT AS gap, true AS proved FROM t""",
    "p7_round_trip": "SELECT true AS same, count(*) AS documents FROM documents",
}
