"""DuckDB SQL for the queries of this subpackage that SQL can express."""

ORACLE = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d
    """,
    "op2_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (
            SELECT doc_id, i, md5(substring(h, 2 * i + 1, 400)) AS s
            FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d WHERE len(h) >= 400)
        ), often AS (
            SELECT s FROM w GROUP BY s HAVING count(*) > 1
        ), starts AS (
            SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w SEMI JOIN often USING (s)
        ), marked AS (
            SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
            FROM starts
        ), spans AS (
            SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM marked GROUP BY ALL
        ), per_doc AS (
            SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, list(struct_pack(a := a, b := b) ORDER BY a) AS cuts
            FROM spans GROUP BY doc_id
        ), kept AS (
            SELECT d.doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
                   CASE WHEN cuts IS NULL THEN h ELSE
                       list_reduce(list_prepend('', list_transform(range(0, len(cuts) + 1), lambda k:
                           substring(h, (CASE WHEN k = 0 THEN 0 ELSE 2 * cuts[k].b END) + 1,
                                     (CASE WHEN k = len(cuts) THEN len(h) ELSE 2 * cuts[k + 1].a END)
                                     - (CASE WHEN k = 0 THEN 0 ELSE 2 * cuts[k].b END)))), lambda x, y: x || y)
                   END AS rest
            FROM d LEFT JOIN per_doc USING (doc_id)
        )
        SELECT doc_id, n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans, sha256(unhex(rest)) AS kept_sha256 FROM kept
    """,
    "op6_decontamination": """
        WITH dw AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM documents
        ), bw AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM benchmark
        ), sizes AS (
            SELECT DISTINCT least(len(w), 10) AS n FROM bw WHERE len(w) > 0
        ), bwin AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)
        ), dwin AS (
            SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)
        ), hits AS (
            SELECT doc_id, i, n, item_id FROM dwin JOIN bwin USING (n, win)
        ), hit_words AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
        ), hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
        )
        SELECT dw.doc_id, len(dw.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
    "op8_jaccard_join": """
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), sh AS (
            SELECT DISTINCT doc_id, s FROM (
                SELECT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
                FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
            )
        ), n AS (
            SELECT doc_id, count(*) AS c FROM sh GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ), link AS (
            SELECT common.a, common.b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * common.c >= 75 * (x.c + y.c - common.c)
        ), e AS (
            SELECT a, b FROM link UNION SELECT b, a FROM link
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM d
            UNION
            SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b
        )
        SELECT d.doc_id, coalesce(any_value(n.c), 0) AS n_shingles, min(reach.b) AS component_id
        FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
        GROUP BY d.doc_id
    """,
    "op10_chat_format": """
        WITH c AS (
            SELECT conv_id, list(md5(role || chr(1) || text) ORDER BY turn) AS w, count(*) AS n_turns,
                   string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS body
            FROM conversations GROUP BY conv_id
        ), p AS (
            SELECT DISTINCT array_to_string(list_slice(w, 1, i), ',') AS s
            FROM (SELECT w, unnest(range(1, n_turns)) AS i FROM c)
        ), k AS (
            SELECT c.*, conv_id = min(conv_id) OVER (PARTITION BY array_to_string(w, ','))
                   AND array_to_string(w, ',') NOT IN (SELECT s FROM p) AS kept
            FROM c
        )
        SELECT conv_id, n_turns, kept, CASE WHEN kept THEN body END AS chat FROM k
    """,
}

#: Least of some (cost, edits) pairs; DuckDB compares structs field by field.
_LEAST = "list_min([{}])"


def _edit(state: str, cost: str, letter: str) -> str:
    return f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{letter}')"


def _way(state: str, role: str) -> str:
    """Keeping a row of that role, or making it one."""
    return (
        f"struct_pack(c := CASE WHEN code = 'd' THEN 1000000000 ELSE {state}.c + CASE WHEN code <> lower(code) THEN 3 ELSE 0 END"
        f" + CASE WHEN lower(code) = '{role}' THEN 0 ELSE 3 END END,"
        f" a := {state}.a || CASE WHEN lower(code) = '{role}' THEN 'K' ELSE 'R' END)"
    )


def _inserted(b: list[str]) -> str:
    """The four states after insertions, from the states before."""
    two = _LEAST.format(", ".join([b[2], *[_edit(b[s], "3", "I") for s in (0, 1, 3)]]))
    three = _LEAST.format(", ".join([b[3], _edit(b[2], "3", "I"), *[_edit(b[s], "6", "II") for s in (0, 1)]]))
    return f"{b[0]} AS b0, {b[1]} AS b1, {two} AS b2, {three} AS b3"


_SYSTEM = _way("b0", "s").replace("THEN 0 ELSE 3 END END", "THEN 0 ELSE 1000000000 END END")
ORACLE["op11_conversation_repair"] = f"""
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
                              lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
    ), faulty AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                   lambda c: unicode(c)::BIGINT)), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS f
        FROM conversations, crc
    ), hurt AS (
        SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
        FROM faulty WHERE f <> 0
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
               trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
        FROM hurt
    ), judged AS (
        SELECT *, bare = '' AS blank,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
               right(bare, 1) NOT IN ('.', '!', '?') AS cut_off,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
        FROM placed
    ), coded AS (
        SELECT *, CASE WHEN blank OR again THEN 'd'
                       WHEN left(role, 1) NOT IN ('s', 'u', 'a') THEN CASE WHEN cut_off THEN 'X' ELSE 'x' END
                       WHEN cut_off THEN upper(left(role, 1)) ELSE left(role, 1) END AS code
        FROM judged
    ), ids AS (
        SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)
    ), facts AS (
        SELECT i.c, any_value(i.conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
               count(*) FILTER (NOT blank AND NOT again AND cut_off) AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(pos) AS n
        FROM ids i LEFT JOIN coded d ON i.conv_id IS NOT DISTINCT FROM d.conv_id GROUP BY i.c
    ), steps AS (
        SELECT i.c, d.pos, d.role, d.text, d.code FROM coded d JOIN ids i ON i.conv_id IS NOT DISTINCT FROM d.conv_id
    ), begin AS (
        SELECT struct_pack(c := 0::BIGINT, a := '') AS s0, struct_pack(c := 1000000000::BIGINT, a := '') AS s1
    ), dp AS (
        SELECT c, 0::BIGINT AS pos, {_inserted(["s0", "s1", "s1", "s1"])} FROM ids, begin
        UNION ALL
        SELECT c, pos, {_inserted(["n0", "n1", "n2", "n3"])}
        FROM (
            SELECT dp.c, steps.pos, {_edit("b0", "4", "D")} AS n0,
                   {_LEAST.format(_edit("b1", "4", "D") + ", " + _SYSTEM)} AS n1,
                   {_LEAST.format(", ".join([_edit("b2", "4", "D"), *[_way(f"b{s}", "u") for s in (0, 1, 3)]]))} AS n2,
                   {_LEAST.format(_edit("b3", "4", "D") + ", " + _way("b2", "a"))} AS n3
            FROM dp JOIN steps ON steps.c = dp.c AND steps.pos = dp.pos + 1
        )
    ), done AS (
        SELECT facts.*, {_LEAST.format("b0, b3")} AS best FROM dp JOIN facts ON dp.c = facts.c AND dp.pos = facts.n
    ), letters AS (
        SELECT c, best.a AS audit, unnest(range(1, len(best.a) + 1)) AS k FROM done
    ), marked AS (
        SELECT c, k, audit[k] AS e, sum(CASE WHEN audit[k] <> 'I' THEN 1 ELSE 0 END) OVER w AS pos,
               sum(CASE WHEN audit[k] <> 'D' THEN 1 ELSE 0 END) OVER w AS place
        FROM letters WINDOW w AS (PARTITION BY c ORDER BY k)
    ), kept AS (
        SELECT m.*, s.role, s.text,
               max(CASE WHEN place = 1 AND e = 'K' AND left(s.role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.c) AS led
        FROM marked m LEFT JOIN steps s ON m.c = s.c AND m.pos = s.pos AND m.e <> 'I' WHERE e <> 'D'
    ), mended AS (
        SELECT c, string_agg((CASE WHEN e = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END)
                             || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS said
        FROM kept GROUP BY c
    )
    SELECT conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, best.c AS cost, best.a AS audit,
           sha256(coalesce(said, '')) AS repaired_sha256
    FROM done LEFT JOIN mended USING (c)
"""
