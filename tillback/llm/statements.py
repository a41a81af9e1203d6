"""Checking SQL for the text queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from tillback.llm.quality import REPEAT_WINDOW, RULES, STOP_WORDS, SYMBOLS

GAPS = r"[ \t\n\x0B\f\r]+"


def quality_statement() -> str:
    """Counts of words, windows and lines with unnested words, and the threshold table as conditions."""
    stops = ", ".join(f"'{word}'" for word in sorted(set(STOP_WORDS)))
    held = []
    for rule in RULES:
        ratio = f"({rule.part}) / nullif(({rule.whole})::double, 0)"
        bounds = [f"{ratio} >= {rule.low}"] * (rule.low > 0) + [f"{ratio} <= {rule.high}"] * (rule.high != float("inf"))
        held.append(f"(n_words < {rule.words} or coalesce({' and '.join(bounds)}, true))")
    window = " || ' ' || ".join(f"lead(word, {k}) over place" if k else "word" for k in range(REPEAT_WINDOW))
    return f"""
        with texts as (select doc_id, coalesce(text, '') as text from documents),
        words as (
            select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as nr
            from (select doc_id, list_filter(regexp_split_to_array(text, '{GAPS}'), lambda w: w <> '') as ws from texts)
        ),
        windows as (
            select doc_id, nr, {window} as gram from words window place as (partition by doc_id order by nr)
        ),
        twice as (
            select doc_id, nr from (select *, count(*) over (partition by doc_id, gram) as n from windows where gram is not null)
            where n > 1
        ),
        repeated as (
            select doc_id, count(distinct nr + k) as n_repeat_words
            from twice, (select unnest(range({REPEAT_WINDOW})) as k) group by doc_id
        ),
        counted as (
            select doc_id, count(*) as n_words, sum(length(word))::bigint as word_chars, max(length(word))::bigint as longest_word,
                count(*) filter (where lower(word) in ({stops})) as n_stop_words
            from words group by doc_id
        ),
        lines as (
            select doc_id, line from (select doc_id, unnest(string_split(text, chr(10))) as line from texts)
            where regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]')
        ),
        lined as (
            select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines,
                count(*) filter (where regexp_matches(line, '^ *[-*\\x{{2022}}]')) as n_bullet_lines,
                count(*) filter (where regexp_matches(line, '(\\.\\.\\.|\\x{{2026}}) *$')) as n_cut_lines
            from lines group by doc_id
        ),
        measured as (
            select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars, coalesce(longest_word, 0) as longest_word,
                length(text) - length(translate(text, '{SYMBOLS}', '')) as n_symbols, coalesce(n_stop_words, 0) as n_stop_words,
                coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_bullet_lines, 0) as n_bullet_lines,
                coalesce(n_cut_lines, 0) as n_cut_lines, coalesce(n_repeat_words, 0) as n_repeat_words
            from texts left join counted using (doc_id) left join lined using (doc_id) left join repeated using (doc_id)
        ),
        judged as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured)
        select *, not base_failed and {' and '.join(held)} as kept from judged
    """


SEARCH = """
    with numbers as (
        select vec_id, list_transform(embedding, lambda v: floor(256 * v::double)::bigint) as x from embeddings
        where embedding is not null and list_bool_and(list_transform(embedding, lambda v: v is not null and isfinite(v)))
    ),
    scored as (
        select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::bigint as score
        from numbers q, numbers c where q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
    )
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
    from scored qualify rank <= 5
"""

# crc32 of the decimal number, byte by byte and bit by bit.
CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

TRIE = f"""
    with turns as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i
        from conversations where conv_id is not null
    ),
    sizes as (select conv_id, count(*) as n, ({CRC}) % 6 as h, conv_id - conv_id % 100 as base from turns group by conv_id),
    planned as (select s.*, least(s.h, coalesce(b.n, 0)) as p from sizes s left join sizes b on s.base = b.conv_id),
    rebuilt as (
        select conv_id, i - h + p as d, role, text from turns join planned using (conv_id) where i > h
        union all
        select planned.conv_id, i, role, text from planned join turns on base = turns.conv_id where i <= p
    ),
    steps as (select conv_id, d, sha256(concat_ws(chr(31), role, text)) as step, length(text) as chars from rebuilt),
    paths as (
        select conv_id, d, chars, list(step) over (partition by conv_id order by d) as path from steps
        union all
        select conv_id, 0, 0, [] from sizes
    ),
    ends as (select conv_id, arg_max(path, d) as path from paths group by conv_id),
    nodes as (select path, d as depth, any_value(chars) as chars, count(*) as n_convs, min(conv_id) as conv_id from paths group by path, d),
    kids as (select path[1 : depth - 1] as path, count(*) as n_children from nodes where depth > 0 group by 1),
    ended as (select path, string_agg(conv_id::varchar, ',' order by conv_id) as ids from ends group by path),
    known as (
        select nodes.*, coalesce(n_children, 0) as n_children, sha256(coalesce(ids, '')) as ends_sha256
        from nodes left join kids using (path) left join ended using (path)
    ),
    summed as (
        select path[1 : k] as path, count(*) filter (where n_children = 0) as n_leaves, sum((n_convs - 1) * chars)::bigint as saved_tokens
        from (select *, unnest(range(depth + 1)) as k from known) group by 1
    )
    select known.conv_id, known.depth, parents.conv_id as parent_conv_id, known.n_convs, known.n_children, n_leaves, saved_tokens,
        known.ends_sha256
    from known join summed using (path) left join nodes parents on known.depth > 0 and parents.path = known.path[1 : known.depth - 1]
"""

TERMS = """unnest(regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"""

LEXICAL = f"""
    with words as (select doc_id, {TERMS.format(text="text")} as term from documents),
    lengths as (select doc_id, count(*) as n from words group by doc_id),
    totals as (select count(*) as documents, sum(n)::bigint as terms from lengths),
    asked as (
        select item_id, term, count(*) as q from (select item_id, {TERMS.format(text="text")} as term from benchmark)
        group by item_id, term
    ),
    occurring as (select doc_id, term, count(*) as tf from words semi join asked using (term) group by doc_id, term),
    weights as (
        select term, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)::double))::bigint as w
        from occurring, totals group by term
    ),
    gains as (
        select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // terms))) as gain
        from occurring join weights using (term) join lengths using (doc_id), totals
    ),
    scored as (select item_id, doc_id, sum(q * gain)::bigint as score from asked join gains using (term) group by item_id, doc_id)
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
    from scored where score > 0 qualify rank <= 20
"""

STATEMENTS = {
    "op3_quality_rules": quality_statement(), "op7_exact_top_k": SEARCH, "op12_conversation_trie": TRIE, "op13_lexical_search": LEXICAL,
}
