"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from clonarium.llm.pii import IBAN_COUNTRIES

_ROLE_MARKS = "CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 END"

# The plain patterns; kind, rank, pattern, context words, score, what confirms a match.
_DIGITS = "regexp_replace(found, '[^0-9]', '', 'g')"
_KINDS = [
    ("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "mail|contact|write to", 0.9, "true"),
    ("ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "ip|host|server|address", 0.6,
     r"regexp_full_match(found, '(0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.|$)){4}')"),
    ("card", 2, r"[0-9]([\x20-]?[0-9])+", "card|visa|credit|payment", 0.7, f"""length({_DIGITS}) BETWEEN 12 AND 19 AND
        list_sum([CASE WHEN i % 2 = 0 THEN CAST(substr({_DIGITS}, length({_DIGITS}) - i, 1) AS INT)
                       WHEN CAST(substr({_DIGITS}, length({_DIGITS}) - i, 1) AS INT) > 4
                       THEN 2 * CAST(substr({_DIGITS}, length({_DIGITS}) - i, 1) AS INT) - 9
                       ELSE 2 * CAST(substr({_DIGITS}, length({_DIGITS}) - i, 1) AS INT) END
                  FOR i IN range(CAST(length({_DIGITS}) AS INT))]) % 10 = 0"""),
    ("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", "phone|call|tel|mobile|fax", 0.6, f"length({_DIGITS}) BETWEEN 9 AND 15"),
]

_MATCHES = " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, i, matches[i] AS found, pieces[i] AS piece,
               {score} + CASE WHEN regexp_matches(lower(right(pieces[i], 40)), '{words}') THEN 0.1 ELSE 0 END AS score
        FROM (SELECT doc_id, matches, pieces, unnest(range(1, len(matches) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS matches, string_split_regex(t, '{pattern}') AS pieces
                    FROM docs))"""
    for kind, rank, pattern, words, score, _ in _KINDS
)
_CONFIRMED = " ".join(f"WHEN '{kind}' THEN {test}" for kind, *_, test in _KINDS)


def _number(length: int, countries: str) -> str:
    """An account number of so many characters, spaces between blocks of four aside."""
    blocks, rest = divmod(length - 4, 4)
    last = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{blocks}}}{last}"


_NUMBERS = "|".join(_number(n, countries) for n, countries in IBAN_COUNTRIES.items())
_MOD97 = """list_reduce([CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END
                     FOR c IN string_split(substr(replace(found, ' ', ''), 5) || substr(replace(found, ' ', ''), 1, 4), '')],
                    lambda a, b: CASE WHEN b >= 10 THEN (a * 100 + b) % 97 ELSE (a * 10 + b) % 97 END, 0) = 1"""
# Account numbers: wherever two letters and two digits stand, as long as the country says; of those that
# overlap the first stays. The longest has 33 characters and eight spaces.
_ACCOUNTS = rf"""
        heads AS (SELECT doc_id, t, CAST(sum(length(pieces[i]) + 4) OVER (PARTITION BY doc_id ORDER BY i) - 4 AS BIGINT) AS begin
                  FROM (SELECT *, unnest(range(1, len(pieces))) AS i
                        FROM (SELECT doc_id, t, string_split_regex(t, '[A-Z]{{2}}[0-9]{{2}}') AS pieces FROM docs))),
        numbers AS (SELECT *, lag(begin + length(found), 1, 0) OVER (PARTITION BY doc_id ORDER BY begin) AS before
                    FROM (SELECT *, regexp_extract(substr(t, begin + 1, 60), '^({_NUMBERS})(?:[^A-Z0-9]|$)', 1) AS found FROM heads)
                    WHERE found <> ''),
        sure AS (SELECT doc_id, begin, begin + length(found) AS stop,
                        0.8 + CASE WHEN regexp_matches(lower(right(substr(t, before + 1, greatest(begin - before, 0)), 40)), 'iban|account|bank')
                                   THEN 0.1 ELSE 0 END AS score
                 FROM numbers WHERE {_MOD97}),
        accounts AS (SELECT doc_id, unnest(list_reduce(list([{{'begin': begin, 'stop': stop, 'score': score}}] ORDER BY begin),
                                lambda kept, x: CASE WHEN x[1].begin < kept[-1].stop THEN kept ELSE kept || x END), recursive := true)
                     FROM sure GROUP BY doc_id)"""

_LETTERS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Fields of a leaf, and CRC-32 of a document's id, bit by bit.
_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _leaf(n_chars: str) -> str:
    fields = [n_chars if f == "n_chars" else f for f in _FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


_CRC = """xor(list_reduce([CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
                lambda crc, byte: list_reduce([CAST(i AS BIGINT) FOR i IN range(8)],
                    lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, byte)),
                4294967295), 4294967295)"""

_TEXT_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LINES = r"list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))"
_FAILS = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "100 * n_dup_lines > 30 * n_lines",
    "lengths": "(word_chars < 3 * n_words OR word_chars > 10 * n_words)",
}


def _rates() -> str:
    """The highest shrunk failure rate of a host: f_* failures, m_* the mean, b_* the variance between hosts."""
    return ", ".join(
        f"CASE WHEN b_{k} > 0 THEN (f_{k} + m_{k} * (m_{k} * (1 - m_{k}) / b_{k} - 1)) / (n + m_{k} * (1 - m_{k}) / b_{k} - 1) ELSE m_{k} END"
        for k in _FAILS
    )


ORACLES = {
    "op1_pii": f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        placed AS (SELECT *, sum(length(piece) + length(found)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop
                   FROM ({_MATCHES})),
        {_ACCOUNTS},
        spans AS (SELECT *, kind || ':' || begin || ':' || stop AS listed
                  FROM (SELECT doc_id, kind, rank, score, CAST(stop - length(found) AS BIGINT) AS begin, CAST(stop AS BIGINT) AS stop
                        FROM placed WHERE CASE kind {_CONFIRMED} END
                        UNION ALL SELECT doc_id, 'iban', 4, score, begin, stop FROM accounts)),
        found AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
                         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
                         count(*) FILTER (kind = 'iban') AS n_iban, max(score) AS top,
                         string_agg(listed, ',' ORDER BY begin, rank) AS listed,
                         string_agg(listed, ',' ORDER BY begin, rank) FILTER (kind <> 'iban') AS base
                  FROM spans GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
               coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(listed, '') AS spans,
               coalesce(n_iban, 0) AS n_iban, CAST(round(coalesce(top, 0), 2) AS DOUBLE) AS top_score
        FROM docs d LEFT JOIN found f ON d.doc_id = f.doc_id""",
    "op2_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
                  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        named AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM named LEFT JOIN counted USING (vec_id)""",
    "op4_chat_format": rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        shown AS (SELECT *, {_ROLE_MARKS} + length(regexp_replace(
            text, '([<\[])(\\*)(/?INST\]|/?s>|</?SYS>>|ROLE |/ROLE\])', '\1\\\2\3', 'g')) AS n_shown FROM turns)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(n_shown) AS BIGINT) AS formatted_chars
        FROM shown GROUP BY conv_id""",
    "op6_decontaminate": f"""
        WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        items AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
        windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
                    FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i
                          FROM items WHERE len(w) > 0)),
        places AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS phrase
                   FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                         FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
        hits AS (SELECT doc_id, item_id, i, size FROM places JOIN windows USING (size, phrase)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id),
        phrases AS (SELECT row_number() OVER (ORDER BY phrase) AS id, phrase, size FROM (SELECT DISTINCT phrase, size FROM windows)),
        terms AS (SELECT id, size, unnest(range(size)) AS j, unnest(string_split(phrase, ' ')) AS word FROM phrases),
        stand AS (SELECT doc_id, len(w) AS n, unnest(range(len(w))) AS p, unnest(w) AS word FROM docs),
        whole AS (SELECT doc_id, id FROM (SELECT DISTINCT id, word, len(list_distinct(string_split(phrase, ' '))) AS m
                                         FROM terms JOIN phrases USING (id))
                 JOIN (SELECT DISTINCT doc_id, word FROM stand) USING (word) GROUP BY doc_id, id, m HAVING count(*) = m),
        starts AS (SELECT doc_id, id, size, j, p - j + d AS s
                   FROM whole JOIN terms USING (id) JOIN stand USING (doc_id, word), (SELECT unnest([-1, 0, 1]) AS d)
                   WHERE p - j + d BETWEEN 0 AND n - size),
        near AS (SELECT DISTINCT doc_id, id
                 FROM (SELECT doc_id, id, size, s FROM starts GROUP BY ALL HAVING count(DISTINCT j) = size)),
        nearby AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM near JOIN phrases USING (id) JOIN windows USING (phrase) GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
               coalesce(n_near, 0) AS n_near
        FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN nearby USING (doc_id)""",
    "op11_merkle_manifest": f"""
        WITH RECURSIVE leaves AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY lang) AS n
            FROM (SELECT doc_id, coalesce('=' || lang, '') AS lang, {_leaf("n_chars")} AS leaf,
                         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS claimed FROM documents)),
        nodes AS (
            SELECT lang, 0 AS height, place, leaf AS node, n FROM leaves
            UNION ALL
            SELECT lang, height + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2
            FROM nodes WHERE n > 1 GROUP BY lang, height, place // 2, n),
        groups AS (SELECT lang, node, row_number() OVER (ORDER BY lang) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
        tops AS (
            SELECT 0 AS height, place, node, n FROM groups
            UNION ALL
            SELECT height + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2
            FROM tops WHERE n > 1 GROUP BY height, place // 2, n),
        low AS (
            SELECT doc_id, leaf, lang, place AS first_place, 0 AS height, place, n, claimed AS node, '' AS proof FROM leaves
            UNION ALL
            SELECT l.doc_id, l.leaf, l.lang, l.first_place, l.height + 1, l.place // 2, (l.n + 1) // 2,
                   sha256(CASE WHEN l.place % 2 = 1 THEN coalesce(o.node, '') || l.node ELSE l.node || coalesce(o.node, '') END),
                   l.proof || coalesce(o.node, '')
            FROM low l LEFT JOIN nodes o ON o.lang = l.lang AND o.height = l.height AND o.place = xor(l.place, 1)
            WHERE l.n > 1),
        high AS (
            SELECT l.doc_id, l.leaf, g.node AS subroot, l.lang, l.first_place, 0 AS height, g.place, g.n, l.node, l.proof
            FROM low l JOIN groups g ON g.lang = l.lang WHERE l.n = 1
            UNION ALL
            SELECT l.doc_id, l.leaf, l.subroot, l.lang, l.first_place, l.height + 1, l.place // 2, (l.n + 1) // 2,
                   sha256(CASE WHEN l.place % 2 = 1 THEN coalesce(o.node, '') || l.node ELSE l.node || coalesce(o.node, '') END),
                   l.proof || coalesce(o.node, '')
            FROM high l LEFT JOIN tops o ON o.height = l.height AND o.place = xor(l.place, 1)
            WHERE l.n > 1)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h.node AS folded_root, h.node = root AS verified
        FROM high h, (SELECT node AS root FROM tops WHERE n = 1) WHERE n = 1""",
    "op13_host_rules": f"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_TEXT_WORDS} AS w, {_LINES} AS lines FROM documents),
        windows AS (SELECT r, i, array_to_string(w[i : i + 7], ' ') AS phrase
                    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) > 8)),
        often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, phrase) AS n FROM windows) WHERE n > 1),
        repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM often) GROUP BY r),
        counted AS (
            SELECT doc_id, source, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
            FROM docs LEFT JOIN repeated USING (r)),
        hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n,
                         {", ".join(f"CAST(count(*) FILTER ({rule}) AS DOUBLE) AS f_{k}" for k, rule in _FAILS.items())}
                  FROM counted WHERE source IS NOT NULL GROUP BY source),
        means AS (SELECT sum(n) AS total, count(*) AS hosts, {", ".join(f"sum(f_{k}) / sum(n) AS m_{k}" for k in _FAILS)} FROM hosts),
        prior AS (SELECT means.*, {", ".join(
            f"(SELECT sum(f_{k} * f_{k} / n) FROM hosts) / total - m_{k} * m_{k} - m_{k} * (1 - m_{k}) * hosts / total AS b_{k}"
            for k in _FAILS)} FROM means),
        rejected AS (SELECT source FROM hosts, prior WHERE greatest({_rates()}) > 0.5),
        judged AS (SELECT *, {_FAILS["short"]} OR {_FAILS["repeats"]} AS base_failed,
                          source IS NOT NULL AND source IN (SELECT source FROM rejected) AS host_rejected FROM counted)
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
               CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
               NOT base_failed AND NOT host_rejected AS kept, host_rejected
        FROM judged""",
}
