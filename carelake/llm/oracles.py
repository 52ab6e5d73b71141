"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from carelake.llm.queries import DOMAINS, MIX_LEVELS, MIX_SEED, MIX_WEIGHTS
from carelake.llm.secrets import BASE_RULES, RULES

SHARDS_SQL = """
WITH RECURSIVE table_bits AS (  -- the 256 entries of the CRC-32 table, eight halvings each
    SELECT i::UINTEGER AS i, i::UINTEGER AS v, 0 AS step FROM range(256) r(i)
    UNION ALL
    SELECT i, CASE WHEN v & 1 = 1 THEN xor(3988292384::UINTEGER, v >> 1) ELSE v >> 1 END, step + 1
    FROM table_bits WHERE step < 8
),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM table_bits WHERE step = 8),
sized AS (
    SELECT doc_id, encode(coalesce(text, '')) AS bytes, coalesce(doc_id::VARCHAR, 'null') AS key
    FROM documents
),
checked AS (
    SELECT doc_id, key, octet_length(bytes) + 1 AS size,
        xor(4294967295::UINTEGER, list_reduce(
            list_prepend(4294967295::UINTEGER,
                list_transform(range(0, octet_length(bytes)),
                    lambda i: ('0x' || substr(hex(bytes), 2 * i::INTEGER + 1, 2))::UINTEGER)),
            lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))::BIGINT AS text_crc32
    FROM sized, crc_table
),
drawn AS (
    SELECT doc_id, key, size, text_crc32, list_transform(range(0, 17), lambda s: {
        'draw': -ln((('0x' || substr(md5('shard:' || s || ':' || key), 1, 13))::BIGINT + 0.5::DOUBLE)
                    / 4503599627370496::DOUBLE),
        'shard': s::INTEGER}) AS draws
    FROM checked
),
won AS (
    SELECT doc_id, size, text_crc32, list_min(draws[1:16]).shard AS shard, list_min(draws).shard AS grown_shard
    FROM drawn
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM won
"""


def _secrets_sql() -> str:
    """Per rule, the text as matches and the gaps between them; all from the rules' own list."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    found = "\n    UNION ALL\n    ".join(
        f"SELECT row_no, {place} AS place, {quote(r.kind)} AS kind, {r.least} AS least,"
        f" regexp_split_to_array(text, {quote(r.regex)}) AS gaps,"
        f" regexp_extract_all(text, {quote(r.regex)}, 0) AS matches,"
        f" regexp_extract_all(text, {quote(r.regex)}, {r.group}) AS parts FROM texts"
        for place, r in enumerate(RULES)
    )
    counts = ", ".join(f"count(*) FILTER (kind = {quote(r.kind)}) AS n_{r.kind}" for r in BASE_RULES)
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place)"
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
),
found AS (
    {found}
),
numbered AS (
    SELECT row_no, place, kind, least, gaps, matches, parts, unnest(range(1, len(matches) + 1))::INTEGER AS i FROM found
),
spans AS (
    SELECT row_no, place, kind, list_sum(list_transform(gaps[1:i], lambda g: length(g)))
        + coalesce(list_sum(list_transform(matches[1:i - 1], lambda m: length(m))), 0) AS start,
        start + length(matches[i]) AS stop
    FROM numbered WHERE length(parts[i]) >= least
),
listed AS (
    SELECT row_no, {counts},
        {listed.replace(')', f') FILTER (place < {len(BASE_RULES)})')} AS base,
        {listed} AS spans
    FROM spans GROUP BY row_no
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row_no)
"""


def _mix_sql() -> str:
    """One block of common tables per level of the tree."""
    quote = lambda v: "'" + str(v) + "'"

    def weight(depth: int) -> str:
        cases = " ".join(
            "WHEN " + " AND ".join(f"{c} = {quote(v)}" for c, v in zip(MIX_LEVELS, path)) + f" THEN {w}"
            for path, w in MIX_WEIGHTS.items() if len(path) == depth
        )
        return f"CASE {cases} ELSE 1 END" if cases else "1"

    blocks = []
    for depth, name in enumerate(MIX_LEVELS, 1):
        path, parent = ", ".join(MIX_LEVELS[:depth]), ", ".join(MIX_LEVELS[: depth - 1])
        family = f"PARTITION BY {parent}" if parent else ""
        given = (
            f"given{depth - 1} USING ({parent})" if parent
            else "(SELECT (SELECT sum(tokens) FROM counted) AS given) ON true"
        )
        blocks.append(f"""
nodes{depth} AS (
    SELECT *, {weight(depth)} AS w FROM
        (SELECT {path}, sum(tokens) * 4 AS cap FROM counted GROUP BY ALL) JOIN {given}
),
marked{depth} AS (
    SELECT *, cap::HUGEINT * sum(w) OVER (need ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        <= (given - coalesce(sum(cap) OVER (need ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT * w AS filled
    FROM nodes{depth} WINDOW need AS ({family} ORDER BY cap / w, {name} NULLS FIRST)
),
shared{depth} AS (
    SELECT *, CASE WHEN filled THEN cap::HUGEINT ELSE
        ((given - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({family}))::HUGEINT * w)
        // sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({family}) END AS share
    FROM marked{depth}
),
given{depth} AS (
    SELECT {path}, (share + CASE WHEN NOT filled AND
        row_number() OVER (PARTITION BY {parent + ", " if parent else ""}filled ORDER BY {name} NULLS FIRST)
        <= given - sum(share) OVER ({family}) THEN 1 ELSE 0 END)::BIGINT AS given
    FROM shared{depth}
)""")
    leaf = ", ".join(MIX_LEVELS)
    number = f"('0x' || substr(md5('{MIX_SEED}:' || full_epochs || ':' || doc_id), 1, 15))::BIGINT"
    domains = ", ".join(quote(d) for d in DOMAINS)
    return f"""
WITH counted AS (
    SELECT doc_id, coalesce([{domains}][try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INTEGER)
            % {len(DOMAINS)} + 1], 'other') AS domain, lang, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
    FROM documents
),{",".join(blocks)},
leaves AS (
    SELECT *, given // leaf_tokens AS full_epochs, given % leaf_tokens AS rest
    FROM (SELECT {leaf}, sum(tokens)::BIGINT AS leaf_tokens FROM counted GROUP BY ALL) JOIN given3 USING ({leaf})
    WHERE leaf_tokens > 0
),
ordered AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY {leaf} ORDER BY {number}, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM counted JOIN leaves USING ({leaf})
)
SELECT doc_id, {leaf}, tokens, unnest(range(full_epochs + (before < rest)::INTEGER))::INTEGER AS epoch,
    leaf_tokens, given AS leaf_budget
FROM ordered
"""


SUBSTRINGS_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
windows AS (
    SELECT row_no, i, array_to_string(w[i:i + 34], ' ') AS passage
    FROM (SELECT row_no, w, unnest(range(1, len(w) - 33)) AS i FROM texts)
),
repeated AS (
    SELECT row_no, list(i) AS places FROM windows
    WHERE passage IN (SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1) GROUP BY row_no
),
covered AS (
    SELECT row_no, list_distinct(flatten(list_transform(places, lambda i: range(i, i + 35)))) AS gone FROM repeated
),
words AS (SELECT row_no, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts),
gone AS (SELECT row_no, unnest(gone) AS i FROM covered),
kept AS (
    SELECT row_no, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
    FROM words ANTI JOIN gone USING (row_no, i) GROUP BY row_no
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row_no)
"""

TOPK_SQL = """
WITH vectors AS (
    SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.row_no, q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v)::BIGINT AS score
    FROM vectors q JOIN vectors x ON q.row_no <> x.row_no WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RANKED_SQL = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id,
        regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
docs AS (SELECT row_no, doc_id, terms, len(terms) AS n FROM texts WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS all_terms FROM docs),
counted AS (
    SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM docs) GROUP BY ALL
),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM counted, total GROUP BY term, docs
),
items AS (
    SELECT row_number() OVER () AS no, item_id, unnest(list_distinct(
        regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
    FROM benchmark
),
scored AS (
    SELECT no, item_id, row_no, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // all_terms))))::BIGINT AS score
    FROM items JOIN weights USING (term) JOIN counted USING (term) JOIN docs USING (row_no), total
    GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

def _repair_sql() -> str:
    """Costs and audits per state of the grammar, turn by turn; no alignment with strings."""
    more = lambda v, cost, initial: f"{{'c': {v}.c + {cost}, 'a': {v}.a || '{initial}'}}"
    never = "{'c': 1000000000, 'a': ''}"

    def inserted(v: str) -> str:
        us = ", ".join(more(f"{v}.{x}", 5, "I") for x in ("e", "s", "a"))
        return f"{{'e': {v}.e, 's': {v}.s, 'u': list_min([{v}.u, {us}]), 'a': list_min([{v}.a, {more(f'{v}.u', 5, 'I')}])}}"

    def step() -> str:
        def fit(letter: str) -> str:
            return f"(CASE WHEN must THEN 1000000 WHEN initial = '{letter}' THEN 0 ELSE 1 END + CASE WHEN cut THEN 5 ELSE 0 END)"

        def to(letter: str, *froms: str) -> str:
            return ", ".join(
                f"{{'c': v.{x}.c + {fit(letter)}, 'a': v.{x}.a || CASE WHEN initial = '{letter}' THEN 'K' ELSE 'R' END}}" for x in froms
            )

        only_s = f"CASE WHEN initial = 's' THEN {{'c': v.e.c + {fit('s')}, 'a': v.e.a || 'K'}} ELSE {never} END"
        gone = {x: more(f"v.{x}", 2, "D") for x in "esua"}
        return (
            f"{{'e': {gone['e']}, 's': list_min([{gone['s']}, {only_s}]),"
            f" 'u': list_min([{gone['u']}, {to('u', 'e', 's', 'a')}]), 'a': list_min([{gone['a']}, {to('a', 'u')}])}}"
        )

    return f"""
WITH RECURSIVE table_bits AS (  -- the 256 entries of the CRC-32 table, eight halvings each
    SELECT i::UINTEGER AS i, i::UINTEGER AS v, 0 AS step FROM range(256) r(i)
    UNION ALL
    SELECT i, CASE WHEN v & 1 = 1 THEN xor(3988292384::UINTEGER, v >> 1) ELSE v >> 1 END, step + 1
    FROM table_bits WHERE step < 8
),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM table_bits WHERE step = 8),
named AS (
    SELECT row_number() OVER () AS row, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS bytes
    FROM conversations
),
drawn AS (
    SELECT * EXCLUDE (bytes), xor(4294967295::UINTEGER, list_reduce(
        list_prepend(4294967295::UINTEGER, list_transform(range(0, octet_length(bytes)),
            lambda i: ('0x' || substr(hex(bytes), 2 * i::INTEGER + 1, 2))::UINTEGER)),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))::BIGINT % 20 AS kind
    FROM named, crc_table
),
turns AS (
    SELECT row, conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM drawn WHERE kind <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), row, copy) AS pos FROM turns
),
judged AS (
    SELECT conv_id, turn, pos, role, text, left(role, 1) AS initial,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair,
        NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
        NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS twice,
        NOT blank AND NOT twice AND NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut,
        blank OR twice AS must
    FROM placed
),
summed AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (twice) AS duplicate, count(*) FILTER (cut) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
),
started AS (SELECT {{'e': {{'c': 0, 'a': ''}}, 's': {never}, 'u': {never}, 'a': {never}}} AS v),
states AS (
    SELECT conv_id, 0::BIGINT AS pos, {inserted('w')} AS v
    FROM summed, (SELECT {inserted('v')} AS w FROM started)
    UNION ALL
    SELECT conv_id, pos, {inserted('w')} FROM (SELECT conv_id, pos, {inserted('w')} AS w FROM (
        SELECT judged.conv_id, judged.pos, {step()} AS w
        FROM states JOIN judged ON judged.conv_id IS NOT DISTINCT FROM states.conv_id AND judged.pos = states.pos + 1))
),
ended AS (
    SELECT conv_id, list_min([v.e, v.a]) AS best FROM states QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1
),
edits AS (SELECT conv_id, unnest(string_split(best.a, '')) AS edit, unnest(range(1, length(best.a) + 1)) AS i FROM ended),
counted AS (
    SELECT *, count(*) FILTER (edit <> 'I') OVER before AS pos, count(*) FILTER (edit <> 'D') OVER before AS said,
        count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id) AS length
    FROM edits WINDOW before AS (PARTITION BY conv_id ORDER BY i)
),
texts AS (
    SELECT counted.conv_id, string_agg(
        CASE WHEN edit = 'K' THEN role WHEN (said - 1 - length % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END
            || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS repaired
    FROM counted LEFT JOIN judged ON judged.conv_id IS NOT DISTINCT FROM counted.conv_id AND judged.pos = counted.pos
    WHERE edit <> 'D' GROUP BY counted.conv_id
)
SELECT named_convs.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
    coalesce(best.a, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) named_convs
LEFT JOIN summed ON summed.conv_id IS NOT DISTINCT FROM named_convs.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM named_convs.conv_id
LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM named_convs.conv_id
"""


def all_oracles() -> dict[str, str]:
    return {
        "op13_turn_alignment": _repair_sql(),
        "op12_k2_treap_search": RANKED_SQL,
        "op2_superkmer_dedup": SUBSTRINGS_SQL,
        "op7_dual_tree_topk": TOPK_SQL,
        "op3_hierarchical_mix": _mix_sql(),
        "op1_rendezvous_shards": SHARDS_SQL,
        "op10_trigram_secrets": _secrets_sql(),
    }
