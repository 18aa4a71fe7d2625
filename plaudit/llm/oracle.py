"""SQL for another engine, for the operators that SQL can express.

Not expressible: learned models (op1, op6, op7), public tokenizers (op3, op8, op12), the 64-bit hash of the fingerprints (op10) and
strings of bytes at any place (op5); tests hold these against brute force.
"""

from plaudit.llm.rules import LONGEST, N_CLASSES, N_COMMON

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SUBSTRING = f"""
WITH split AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS passage
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) AS i FROM split)),
firsts AS (SELECT passage, min(doc_id) AS first_id FROM windows GROUP BY passage),
gone AS (
    SELECT DISTINCT doc_id, place FROM (
        SELECT doc_id, unnest(range(i, i + 13)) AS place
        FROM windows JOIN firsts USING (passage) WHERE first_id < doc_id)),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM split),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS rest, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

CONTAMINATION = f"""
WITH split AS (SELECT doc_id, {_PLAIN} AS ws FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN} AS ws FROM benchmark),
patterns AS (
    SELECT DISTINCT item, least(len(ws), 13) AS size, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS passage
    FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM patterns),
windows AS (
    SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS passage
    FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
          FROM split, sizes WHERE len(ws) >= size)),
hits AS (SELECT doc_id, i, size, item FROM windows JOIN patterns USING (size, passage)),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(ws) AS contaminated
FROM split LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def _count(letters: str) -> str:
    letters = letters.replace("'", "''")
    return f"length(t) - length(translate(t, '{letters}', ''))"


def _distance(p: str, q: str, size: int) -> str:
    def part(x: str, y: str) -> str:
        return f"CASE WHEN {x}[i] > 0 THEN {x}[i] * log2(2 * {x}[i] / ({x}[i] + {y}[i])) ELSE 0.0 END"

    return (f"CASE WHEN {p} IS NOT NULL AND {q} IS NOT NULL THEN sqrt(greatest(list_sum(list_transform("
            f"range(1, {size + 1}), lambda i: ({part(p, q)} + {part(q, p)}) / 2)), 0.0)) END")


_N_COMMON = N_COMMON + 1
_MEAN_P = ", ".join(f"avg(p[{k}])" for k in range(1, N_CLASSES + 1))
_MEAN_Q = ", ".join(f"avg(q[{k}])" for k in range(1, _N_COMMON + 1))

RULES = f"""
WITH texts AS (
    SELECT doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS ws,
           regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS small,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents),
lists AS (
    SELECT lang, list(word ORDER BY n DESC, encode(word)) AS listed FROM (
        SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(small) AS word FROM texts)
        WHERE length(word) <= {LONGEST} AND regexp_matches(word, '\\p{{L}}') GROUP BY lang, word
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, encode(word)) <= {N_COMMON}) GROUP BY lang),
triples AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS triple
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM texts)),
repeats AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 3)) AS place
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, triple) AS times FROM triples) WHERE times > 1)
    GROUP BY doc_id),
counts AS (
    SELECT doc_id, texts.lang, len(ws) AS n_words,
           CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
           {_count("#*$%&|<>")} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words, length(t) AS n_chars,
           [length(t) - length(regexp_replace(t, '\\p{{Ll}}', '', 'g')),
            length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')), {_count("0123456789")},
            length(t) - length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')), {_count("#*$%&|<>")},
            {_count(".,;:!?'" + '"()-')}] AS known,
           list_transform(range(1, {N_COMMON + 1}), lambda k: len(list_filter(small, lambda w: w = listed[k]))) AS common
    FROM texts LEFT JOIN repeats USING (doc_id) LEFT JOIN lists ON texts.lang IS NOT DISTINCT FROM lists.lang),
shares AS (
    SELECT *, CASE WHEN word_chars >= 300 THEN
               list_transform(list_append(known, CAST(n_chars - list_sum(known) AS BIGINT)), lambda x: x / n_chars) END AS p,
           CASE WHEN n_words >= 100 THEN list_transform(
               list_append(common, CAST(n_words - list_sum(common) AS BIGINT)), lambda x: x / n_words) END AS q
    FROM counts),
refs AS (SELECT lang, [{_MEAN_P}] AS rp, [{_MEAN_Q}] AS rq FROM shares GROUP BY lang),
far AS (
    SELECT shares.*, {_distance("p", "rp", N_CLASSES)} AS char_distance, {_distance("q", "rq", _N_COMMON)} AS word_distance,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM shares LEFT JOIN refs ON shares.lang IS NOT DISTINCT FROM refs.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (p IS NULL OR char_distance <= 0.25) AND (q IS NULL OR word_distance <= 0.26) AS kept
FROM far
"""

_PARTS, _ENTRIES, _ROUNDS = 8, 16, 6


def _nearest(step: int) -> str:
    """Each part's entry by a full comparison; of equal distances the lower index."""
    return f"""
apart{step} AS MATERIALIZED (
    SELECT vec_id, part, entry, sum((v - c) * (v - c)) AS far
    FROM places JOIN book{step} USING (part, place) GROUP BY vec_id, part, entry),
near{step} AS MATERIALIZED (
    SELECT vec_id, part, entry, far FROM apart{step}
    QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY far, entry) = 1),"""


def _moved(step: int) -> str:
    return f"""
book{step + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, b.place, coalesce(m.c, b.c) AS c FROM book{step} b LEFT JOIN (
        SELECT part, entry, place, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS c
        FROM places JOIN near{step} USING (vec_id, part) GROUP BY part, entry, place) m USING (part, entry, place)),"""


CODES = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints,
           len(embedding) // {_PARTS} AS width
    FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
places AS MATERIALIZED (
    SELECT vec_id, (k - 1) // width AS part, (k - 1) % width AS place, v
    FROM (SELECT vec_id, width, unnest(ints) AS v, generate_subscripts(ints, 1) AS k FROM kept)),
starts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
           QUALIFY row_number() OVER (ORDER BY vec_id) <= {_ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, place, v AS c FROM places JOIN starts USING (vec_id)),
{"".join(_nearest(k) + _moved(k) for k in range(_ROUNDS))}{_nearest(_ROUNDS)}
coded AS (
    SELECT vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
    FROM near{_ROUNDS} GROUP BY vec_id),
labels_added AS (
    SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{_ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id) JOIN labels_added ON kept.label IS NOT DISTINCT FROM labels_added.label
"""

_LEVELS = 9  # of runs of eight, enough for 8 ** 9 documents of a language


def _told(*fields: str) -> str:
    each = (f"coalesce(concat(octet_length(encode(CAST({f} AS VARCHAR))), ':', CAST({f} AS VARCHAR)), '-')" for f in fields)
    return f"sha256(concat({', '.join(each)}))"


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text: eight shifts for each character, by the reversed polynomial."""
    shift = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    eight = "x"
    for _ in range(8):
        eight = f"list_transform([{eight}], lambda c: {shift})[1]"
    codes = f"list_transform(string_split({text}, ''), lambda d: CAST(ascii(d) AS BIGINT))"
    step = f"list_transform([xor(a, b)], lambda x: {eight})[1]"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {step}), 4294967295)"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels over `leaves` (tree, rank, digest, n): at[k] as name, k; and each leaf's siblings by level."""
    levels = [f"{name}0 AS MATERIALIZED ({leaves})"]
    for k in range(1, _LEVELS + 1):
        up = f"{name}{k - 1}"
        levels.append(f"""{name}{k} AS MATERIALIZED (
    SELECT tree, rank // 8 AS rank, sha256(string_agg(digest, '' ORDER BY rank)) AS digest
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {up}) WHERE n > 1 GROUP BY tree, rank // 8)""")
    tops = " UNION ALL ".join(
        f"SELECT tree, min(digest) AS digest FROM {name}{k} GROUP BY tree HAVING count(*) = 1" for k in range(_LEVELS + 1))
    levels.append(f"{name}_tops AS MATERIALIZED ({tops})")
    return ",\n".join(levels)


def _climb(name: str, source: str, keys: str) -> str:
    """From `source` (keys, tree, rank, proof, fold) level by level: others of each run, and the fold."""
    steps = [f"{name}_up0 AS MATERIALIZED (SELECT * FROM {source})"]
    for k in range(_LEVELS):
        steps.append(f"""{name}_runs{k} AS MATERIALIZED (
    SELECT tree, rank // 8 AS up, list(digest ORDER BY rank) AS run FROM {name}{k}
    WHERE tree IN (SELECT tree FROM {name}{k + 1}) GROUP BY tree, rank // 8),
{name}_up{k + 1} AS MATERIALIZED (
    SELECT {keys}, u.tree, CASE WHEN run IS NULL THEN u.rank ELSE u.rank // 8 END AS rank,
           CASE WHEN run IS NULL THEN proof ELSE
               concat(proof, array_to_string(list_concat(run[:u.rank % 8], run[u.rank % 8 + 2:]), '')) END AS proof,
           CASE WHEN run IS NULL THEN fold ELSE
               sha256(concat(array_to_string(run[:u.rank % 8], ''), fold, array_to_string(run[u.rank % 8 + 2:], ''))) END AS fold
    FROM {name}_up{k} u LEFT JOIN {name}_runs{k} r ON r.tree = u.tree AND r.up = u.rank // 8)""")
    return ",\n".join(steps)


MANIFEST = f"""
WITH digests AS MATERIALIZED (
    SELECT doc_id, lang, {_told("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
           CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
                THEN {_told("doc_id", "source", "lang", "n_chars", _LOWER)} END AS tampered
    FROM documents),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS tree
          FROM (SELECT DISTINCT lang FROM documents)),
ranked AS MATERIALIZED (
    SELECT digests.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf) - 1 AS rank
    FROM digests JOIN langs ON digests.lang IS NOT DISTINCT FROM langs.lang),
{_tree("low", "SELECT tree, rank, leaf AS digest FROM ranked")},
{_tree("high", "SELECT 0 AS tree, tree AS rank, digest FROM low_tops")},
begun AS (SELECT doc_id, leaf, tree, rank, '' AS proof, coalesce(tampered, leaf) AS fold FROM ranked),
{_climb("low", "begun", "doc_id, leaf")},
between AS (SELECT doc_id, leaf, low_tops.digest AS subroot, 0 AS tree, u.tree AS rank, proof, fold
            FROM low_up{_LEVELS} u JOIN low_tops USING (tree)),
{_climb("high", "between", "doc_id, leaf, subroot")}
SELECT doc_id, leaf, subroot, high_tops.digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
       fold = high_tops.digest AS verified
FROM high_up{_LEVELS}, high_tops
"""

LLM_ORACLE: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING,
    "op4_benchmark_decontamination": CONTAMINATION,
    "op9_quality_rules": RULES,
    "op11_vector_codes": CODES,
    "op13_merkle_manifest": MANIFEST,
}
