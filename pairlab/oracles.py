"""The same queries in SQL, for a second engine (DuckDB) to check results against.

Each statement is put together from named WITH parts; all run over the whole tables.
"""

from __future__ import annotations

# Fixed values, written out here so that no table under test is its own check.
STOP_WORDS = [
    "the", "a", "an", "and", "of", "to", "in", "for", "on", "with", "is", "are", "was", "were", "be", "by", "at",
    "as", "it", "this", "that", "from", "or", "has", "have", "had", "but", "not", "will", "would", "can", "could",
    "said", "its", "his", "her", "they", "he", "she", "you", "your", "we", "our", "i",
]
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings":
    "inning", "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning", "canning":
    "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli":
    "ful", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
    "iti", "ous", "ive", "ize",
]

WS = r"'\s+'"

# The patterns of the other engine: ``\s`` is enough, the texts hold only blanks and line ends.
PARTS = {
    "pairs": """
        SELECT doc_id AS id,
               CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 = 1 THEN 'validation' ELSE 'train' END AS split,
               CASE WHEN doc_id % 5 = 0 THEN '(CNN) -- ' ELSE '' END ||
               CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) ELSE text END AS article,
               CASE WHEN contains(text, chr(10)) THEN substr(text, 1, strpos(text, chr(10)) - 1) END AS highlights
        FROM documents""",
    "filled": "SELECT * FROM pairs WHERE article IS NOT NULL AND highlights IS NOT NULL",
    "firsts": """
        SELECT * FROM filled
        QUALIFY row_number() OVER (PARTITION BY split, article, highlights ORDER BY id) = 1""",
}


def clean(column: str) -> str:
    untagged = rf"regexp_replace(coalesce({column}, 'nan'), '^\(CNN\)\s*(--)?\s*', '', 'i')"
    undashed = rf"regexp_replace({untagged}, '-{{2,}}', '-', 'g')"
    return rf"trim(regexp_replace({undashed}, {WS}, ' ', 'g'))"


def words(text: str) -> str:
    return rf"[w FOR w IN regexp_split_to_array({text}, {WS}) IF w <> '']"


def word_count(column: str, null_text: str) -> str:
    return rf"CAST(len(regexp_extract_all(coalesce({column}, '{null_text}'), '\S+')) AS BIGINT)"


def sentences(column: str) -> str:
    return (
        rf"[s FOR s IN [trim(regexp_replace(x, {WS}, ' ', 'g')) FOR x IN "
        rf"regexp_extract_all({column}, '[^.!?]+[.!?]*')] IF s <> '']"
    )


def rouge_tokens(column: str) -> str:
    return f"[t FOR t IN regexp_split_to_array(lower({column}), '[^a-z0-9]+') IF t <> '']"


FITS = "length(article) BETWEEN 200 AND 20000 AND length(highlights) BETWEEN 20 AND 2000"
STOPS = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"

PARTS |= {
    "cleaned": f"SELECT id, split, {clean('article')} AS article, {clean('highlights')} AS highlights FROM filled",
    "cleaned_firsts": f"SELECT id, split, {clean('article')} AS article, {clean('highlights')} AS highlights FROM firsts",
    "processed": f"SELECT * FROM cleaned_firsts WHERE {FITS}",
    "lengths": f"""
        SELECT id, split,
               CAST(length(coalesce(article, '')) AS BIGINT) AS article_chars,
               CAST(length(coalesce(highlights, '')) AS BIGINT) AS summary_chars,
               {word_count('article', '')} AS article_words,
               {word_count('highlights', '')} AS summary_words
        FROM pairs""",
    "nan_words": f"""
        SELECT id, split, {word_count('article', 'nan')} AS article, {word_count('highlights', 'nan')} AS summary
        FROM pairs""",
    "counted": rf"""
        SELECT id, [w FOR w IN {words("lower(coalesce(highlights, 'nan'))")}
                    IF regexp_full_match(w, '\p{{L}}+') AND w NOT IN {STOPS}] AS w
        FROM pairs""",
    "lead": f"""
        SELECT id, article, highlights AS reference_summary,
               array_to_string(list_slice({sentences('article')}, 1, 3), ' ') AS generated_summary
        FROM cleaned""",
}


def with_parts(names: str, body: str) -> str:
    """A statement with the named parts, written in the order in which they build on each other."""
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in names.split()) + "\n" + body


def sampled(source: str, n: int) -> str:
    return f"SELECT * FROM {source} ORDER BY md5('42:' || id), id LIMIT {n}"


def stats(metric: str) -> str:
    return f"""
        SELECT '{metric}' AS metric,
               round(coalesce(avg({metric}), 0), 6) AS mean,
               round(coalesce(quantile_cont({metric}, 0.5), 0), 6) AS median,
               round(coalesce(stddev_pop({metric}), 0), 6) AS std,
               coalesce(min({metric}), 0) AS min, coalesce(max({metric}), 0) AS max,
               round(coalesce(quantile_cont({metric}, 0.9), 0), 6) AS p90,
               round(coalesce(quantile_cont({metric}, 0.95), 0), 6) AS p95,
               round(coalesce(quantile_cont({metric}, 0.99), 0), 6) AS p99
        FROM lengths"""


def token_stats(source: str) -> str:
    return f"""
        SELECT count(*) AS sample_size,
               round(avg(article), 6) AS article_tokens_mean,
               round(quantile_cont(article, 0.95), 6) AS article_tokens_p95,
               round(avg(summary), 6) AS summary_tokens_mean,
               round(quantile_cont(summary, 0.95), 6) AS summary_tokens_p95
        FROM {source}"""


def histogram(side: str) -> str:
    return f"""
        SELECT '{side}' AS side,
               CAST(CASE WHEN hi = lo THEN 26 ELSE least(((v - lo) * 50) // (hi - lo) + 1, 50) END AS BIGINT) AS bucket,
               count(*) AS n
        FROM (SELECT {side} AS v, min({side}) OVER () AS lo, max({side}) OVER () AS hi FROM nan_words)
        GROUP BY ALL"""


def grams(n: int, tokens: str) -> str:
    """List of n-grams of a token list, joined by a blank."""
    return f"[array_to_string({tokens}[i:i + {n - 1}], ' ') FOR i IN range(1, len({tokens}) - {n - 2})]"

# Porter steps over a table of distinct tokens, as regular expressions.  A leading y is written Y: a consonant.
_CONSONANTS, _VOWELS = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"


def _has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


def _measure_above_0(x: str) -> str:
    return _has(x, f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}")


def _measure_is_1(x: str) -> str:
    return _has(x, f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}({_VOWELS})?$")


def _measure_above_1(x: str) -> str:
    return _has(x, f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}{_VOWELS}{_CONSONANTS}")


def _has_vowel(x: str) -> str:
    return _has(x, f"^({_CONSONANTS})?[aeiouy]")


def _short(x: str) -> str:
    return f"({_has(x, f'^{_CONSONANTS}[aeiouy][^aeiouwxy]$')} OR {_has(x, '^[aeiou][^aeiou]$')})"


def _cut(x: str, n: int) -> str:
    return f"substr({x}, 1, length({x}) - {n})"


def _suffix_rules(rules: dict[str, str], allowed) -> str:
    """Longest suffix first; a suffix that matches but may not fire ends the step."""
    cases = [
        f"WHEN suffix(x, '{old}') THEN CASE WHEN {allowed(old)} THEN {_cut('x', len(old))} || '{new}' ELSE x END"
        for old, new in sorted(rules.items(), key=lambda rule: -len(rule[0]))
    ]
    return "CASE " + " ".join(cases) + " ELSE x END"


def _step_2_allowed(old: str) -> str:
    return _measure_above_0(_cut("x", 3 if old == "logi" else len(old)))


def _step_4_allowed(old: str) -> str:
    rest = _cut("x", len(old))
    return _measure_above_1(rest) + (f" AND {_has(rest, '[st]$')}" if old == "ion" else "")


def stem_parts(source: str) -> str:
    """WITH parts from a table ``source(token)`` to ``stems(token, stem)``."""
    irregular = ", ".join(f"'{w}'" for w in IRREGULAR)
    steps = {
        "st0": f"SELECT token, regexp_replace(token, '^y', 'Y') AS x FROM {source} "
        f"WHERE length(token) > 3 AND token NOT IN ({irregular})",
        "st1a": f"""SELECT token, CASE WHEN suffix(x, 'ies') THEN CASE WHEN length(x) = 4 THEN {_cut('x', 1)} ELSE {_cut('x', 2)} END
            WHEN suffix(x, 'sses') THEN {_cut('x', 2)} WHEN suffix(x, 'ss') THEN x
            WHEN suffix(x, 's') THEN {_cut('x', 1)} ELSE x END AS x FROM st0""",
        "st1r": f"""SELECT token, x, CASE WHEN suffix(x, 'ied') OR suffix(x, 'eed') THEN NULL
            WHEN suffix(x, 'ed') AND {_has_vowel(_cut('x', 2))} THEN {_cut('x', 2)}
            WHEN suffix(x, 'ing') AND {_has_vowel(_cut('x', 3))} THEN {_cut('x', 3)} END AS r FROM st1a""",
        "st1b": f"""SELECT token, CASE
            WHEN suffix(x, 'ied') THEN CASE WHEN length(x) = 4 THEN {_cut('x', 1)} ELSE {_cut('x', 2)} END
            WHEN suffix(x, 'eed') THEN CASE WHEN {_measure_above_0(_cut('x', 3))} THEN {_cut('x', 1)} ELSE x END
            WHEN r IS NULL THEN x
            WHEN {_has('r', '(at|bl|iz)$')} THEN r || 'e'
            WHEN length(r) > 1 AND substr(r, -1) = substr(r, -2, 1) AND {_has('r', '[^aeiouy]$')}
                 THEN CASE WHEN {_has('r', '[lsz]$')} THEN r ELSE {_cut('r', 1)} END
            WHEN {_measure_is_1('r')} AND {_short('r')} THEN r || 'e' ELSE r END AS x FROM st1r""",
        "st1c": f"SELECT token, CASE WHEN length(x) > 2 AND {_has('x', '[^aeiouy]y$')} THEN {_cut('x', 1)} || 'i' ELSE x END AS x FROM st1b",
        "st2a": f"SELECT token, CASE WHEN suffix(x, 'alli') AND {_measure_above_0(_cut('x', 4))} THEN {_cut('x', 2)} ELSE x END AS x FROM st1c",
        "st2": f"SELECT token, {_suffix_rules(STEP_2, _step_2_allowed)} AS x FROM st2a",
        "st3": f"SELECT token, {_suffix_rules(STEP_3, lambda old: _measure_above_0(_cut('x', len(old))))} AS x FROM st2",
        "st4": f"SELECT token, {_suffix_rules(dict.fromkeys(STEP_4, ''), _step_4_allowed)} AS x FROM st3",
        "st5a": f"""SELECT token, CASE WHEN suffix(x, 'e') AND ({_measure_above_1(_cut('x', 1))} OR
            ({_measure_is_1(_cut('x', 1))} AND NOT {_short(_cut('x', 1))})) THEN {_cut('x', 1)} ELSE x END AS x FROM st4""",
        "st5b": f"SELECT token, CASE WHEN suffix(x, 'll') AND {_measure_above_1(_cut('x', 1))} THEN {_cut('x', 1)} ELSE x END AS x FROM st5a",
        "stems": f"""SELECT token, lower(x) AS stem FROM st5b
            UNION ALL SELECT token, CASE token {' '.join(f"WHEN '{w}' THEN '{s}'" for w, s in IRREGULAR.items())} END
                      FROM {source} WHERE length(token) > 3 AND token IN ({irregular})
            UNION ALL SELECT token, token FROM {source} WHERE length(token) <= 3""",
    }
    return ",\n".join(f"{name} AS ({body})" for name, body in steps.items())


def stemmed_tokens(source: str) -> str:
    """WITH parts from a table of texts to ``toks(id, p, r)``, token lists with every token stemmed."""
    pred, ref = "generated_summary", "reference_summary"
    return f"""
        raw AS (SELECT id, {rouge_tokens(pred)} AS p, {rouge_tokens(ref)} AS r FROM {source}
                WHERE {pred} IS NOT NULL AND {ref} IS NOT NULL),
        seen AS (SELECT DISTINCT token FROM (SELECT unnest(list_concat(p, r)) AS token FROM raw)),
        {stem_parts('seen')},
        ps AS (SELECT id, list(stem ORDER BY i) AS p
               FROM (SELECT id, unnest(p) AS token, generate_subscripts(p, 1) AS i FROM raw) JOIN stems USING (token) GROUP BY id),
        rs AS (SELECT id, list(stem ORDER BY i) AS r
               FROM (SELECT id, unnest(r) AS token, generate_subscripts(r, 1) AS i FROM raw) JOIN stems USING (token) GROUP BY id),
        toks AS (SELECT id, coalesce(ps.p, []) AS p, coalesce(rs.r, []) AS r FROM raw LEFT JOIN ps USING (id) LEFT JOIN rs USING (id))"""


def plain_tokens(source: str) -> str:
    pred, ref = "generated_summary", "reference_summary"
    return f"""
        toks AS (SELECT id, {rouge_tokens(pred)} AS p, {rouge_tokens(ref)} AS r FROM {source}
                 WHERE {pred} IS NOT NULL AND {ref} IS NOT NULL)"""


def ngram_scores(n: int) -> str:
    """WITH parts from ``toks`` to ``scores<n>(id, p, r, f1)``: clipped n-gram overlap."""
    return f"""
        gram{n} AS (SELECT id, {grams(n, 'p')} AS p, {grams(n, 'r')} AS r FROM toks),
        pc{n} AS (SELECT id, g, count(*) AS c FROM (SELECT id, unnest(p) AS g FROM gram{n}) GROUP BY ALL),
        rc{n} AS (SELECT id, g, count(*) AS c FROM (SELECT id, unnest(r) AS g FROM gram{n}) GROUP BY ALL),
        ov{n} AS (SELECT id, sum(least(pc{n}.c, rc{n}.c)) AS o FROM pc{n} JOIN rc{n} USING (id, g) GROUP BY id),
        scores{n} AS ({score('gram%d LEFT JOIN ov%d USING (id)' % (n, n))})"""


def score(source: str) -> str:
    """Precision, recall, F1 from an overlap ``o`` and the lists ``p`` and ``r``."""
    return f"""SELECT id, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM (
        SELECT id, CASE WHEN len(p) > 0 THEN coalesce(o, 0) / len(p) ELSE 0 END AS p,
                   CASE WHEN len(r) > 0 THEN coalesce(o, 0) / len(r) ELSE 0 END AS r FROM {source})"""


# Longest common subsequence, one row of the table per round: with c[j] the best of "keep the row above" and
# "match here", the next row is the running maximum of c.
LCS_SCORES = f"""
    small AS (SELECT id, p, r FROM toks WHERE len(p) > 0 AND len(r) > 0),
    cell AS (SELECT id, unnest(r) AS t, generate_subscripts(r, 1) AS j FROM small),
    step AS (
        SELECT id, 0 AS i, j, t, 0 AS v FROM cell
        UNION ALL
        SELECT id, i + 1, j, t, max(c) OVER (PARTITION BY id ORDER BY j) AS v FROM (
            SELECT step.id, i, j, t,
                   CASE WHEN p[i + 1] = t THEN 1 + coalesce(lag(v) OVER (PARTITION BY step.id ORDER BY j), 0) ELSE v END AS c
            FROM step JOIN small ON step.id = small.id WHERE i < len(p))),
    longest AS (SELECT step.id, max(v) AS o FROM step GROUP BY step.id),
    scoresL AS ({score('toks LEFT JOIN longest USING (id)')})"""

LEAD_PARTS = "pairs filled cleaned lead"


def scores_of(parts: str, *more: str, body: str, recursive: bool = False) -> str:
    """A statement with named parts, then further WITH parts, then the body."""
    statement = ",".join([with_parts(parts, "").rstrip(), *more]) + "\n" + body
    return statement.replace("WITH", "WITH RECURSIVE", 1) if recursive else statement


def rounded_scores(table: str) -> str:
    return f"SELECT id, round(p, 6) AS p, round(r, 6) AS r, round(f1, 6) AS f1 FROM {table}"


PARTS |= {
    "optional_lead": f"""
        SELECT id, nullif(highlights, '') AS reference_summary,
               array_to_string(list_slice({sentences(clean('article'))}, 1, 3), ' ') AS generated_summary
        FROM pairs""",
    "vocab_counts": f"""
        SELECT token, count(*) AS n
        FROM (SELECT unnest(list_concat({words("coalesce(article, '')")}, {words("coalesce(highlights, '')")})) AS token FROM pairs)
        GROUP BY token""",
    "vocab": """
        SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 2 AS BIGINT) AS token_id, n
        FROM vocab_counts ORDER BY n DESC, token LIMIT 5000""",
    "kept_words": f"""
        SELECT id, {words("'summarize: ' || coalesce(article, 'nan')")}[1:511] AS source,
               {words("coalesce(highlights, 'nan')")}[1:127] AS target
        FROM pairs""",
    "source_ids": """
        SELECT id, list(coalesce(token_id, 2) ORDER BY pos) AS ids
        FROM (SELECT id, unnest(source) AS token, generate_subscripts(source, 1) AS pos FROM kept_words)
        LEFT JOIN vocab USING (token) GROUP BY id""",
    "target_ids": """
        SELECT id, list(coalesce(token_id, 2) ORDER BY pos) AS ids
        FROM (SELECT id, unnest(target) AS token, generate_subscripts(target, 1) AS pos FROM kept_words)
        LEFT JOIN vocab USING (token) GROUP BY id""",
    "encoded": """
        SELECT k.id, list_resize(list_append(coalesce(s.ids, []), 1), 512, 0) AS input_ids,
               list_resize(list_append(coalesce(t.ids, []), 1), 128, 0) AS targets
        FROM kept_words k LEFT JOIN source_ids s USING (id) LEFT JOIN target_ids t USING (id)""",
    "sentence_rows": f"""
        SELECT id, s, generate_subscripts(s, 1) AS pos, unnest(s) AS sentence
        FROM (SELECT id, {sentences("coalesce(article, '')")} AS s FROM pairs)""",
    "prefixed_rows": f"""
        SELECT id, s, generate_subscripts(s, 1) AS pos, unnest(s) AS sentence
        FROM (SELECT id, {sentences("'summarize: ' || coalesce(article, 'nan')")} AS s FROM pairs)""",
    "sentence_words": rf"""
        SELECT id, pos, w FROM (SELECT id, pos, unnest({words('lower(sentence)')}) AS w FROM sentence_rows)
        WHERE regexp_full_match(w, '\p{{L}}+') AND w NOT IN {STOPS}""",
    "frequencies": "SELECT id, w, count(*) AS c FROM sentence_words GROUP BY id, w",
    "sentence_scores": """
        SELECT id, pos, sum(c) / count(*) AS score FROM sentence_words JOIN frequencies USING (id, w) GROUP BY id, pos""",
    "ranked_sentences": """
        SELECT id, pos, sentence,
               row_number() OVER (PARTITION BY id ORDER BY coalesce(score, 0) DESC, pos) AS place
        FROM sentence_rows LEFT JOIN sentence_scores USING (id, pos)""",
}
# A vocabulary of all words, with a gap after each id.
PARTS["vocab_gaps"] = """
    SELECT token, CAST(2 * (row_number() OVER (ORDER BY n DESC, token) + 2) - 3 AS BIGINT) AS token_id FROM vocab_counts"""
for _part in ("source_ids", "target_ids"):
    PARTS[f"{_part}_gaps"] = PARTS[_part].replace("JOIN vocab USING", "JOIN vocab_gaps USING")
PARTS["encoded_gaps"] = PARTS["encoded"].replace("source_ids", "source_ids_gaps").replace("target_ids", "target_ids_gaps")
EXTRACTIVE_PARTS = "pairs sentence_rows sentence_words frequencies sentence_scores ranked_sentences"
ENCODE_PARTS = "pairs vocab_counts vocab kept_words source_ids target_ids encoded"
CORPUS = ", ".join(
    f'(SELECT round(100 * avg(f1), 4) FROM {table}) AS "{name}"'
    for name, table in {"rouge1": "scores1", "rouge2": "scores2", "rougeL": "scoresL", "rougeLsum": "scoresL"}.items()
)
MASKED = "[CASE WHEN x = 0 THEN -100 ELSE x END FOR x IN targets]"

MATCH_PARTS = """
    tok AS (SELECT CAST(label AS BIGINT) AS id, vec_id, CAST(embedding AS DOUBLE[]) AS v, vec_id % 2 = 0 AS is_pred FROM embeddings),
    best AS (SELECT a.id, a.is_pred, a.vec_id, max(list_cosine_similarity(a.v, b.v)) AS m
             FROM tok a JOIN tok b ON a.id = b.id AND a.is_pred <> b.is_pred GROUP BY ALL),
    pr AS (SELECT id, avg(m) FILTER (is_pred) AS p, avg(m) FILTER (NOT is_pred) AS r FROM best GROUP BY id),
    matched AS (SELECT id, p AS precision, r AS recall, 2 * p * r / (p + r) AS f1 FROM pr)"""

ALL_PAIRS = with_parts("pairs", "SELECT id, split, article, highlights FROM pairs")

ORACLES: dict[str, str] = {
    "pairs_union_splits": ALL_PAIRS,
    "csv_roundtrip": ALL_PAIRS,
    "drop_na": with_parts("pairs filled", "SELECT * FROM filled"),
    "drop_duplicates": with_parts("pairs filled firsts", "SELECT * FROM firsts"),
    "drop_duplicates_repeated_ids": with_parts(
        "pairs filled", "SELECT DISTINCT min(id % 100) OVER (PARTITION BY split, article, highlights) AS id, split, article, highlights FROM filled"
    ),
    "sample_exact_repeated_ids": with_parts("pairs filled", "SELECT least(150, 2 * count(*)) AS num_rows FROM filled"),
    "load_subset_sizes": with_parts(
        "pairs",
        f"""SELECT id, split, article, highlights FROM ({sampled("pairs WHERE split = 'train'", 10)})
            UNION ALL SELECT id, split, article, highlights FROM pairs WHERE split = 'test'""",
    ),
    "processed_empty_split": with_parts(
        "pairs filled firsts cleaned_firsts processed",
        """SELECT s.split, count(p.id) AS num_rows FROM (VALUES ('train'), ('validation'), ('test')) s(split)
           LEFT JOIN processed p ON p.split = s.split AND p.split <> 'validation' GROUP BY s.split""",
    ),
    "encode_pairs_large_vocab": with_parts(
        "pairs vocab_counts vocab_gaps kept_words source_ids_gaps target_ids_gaps encoded_gaps",
        f"""SELECT id, array_to_string(input_ids, ',') AS input_ids, array_to_string({MASKED}, ',') AS labels
            FROM encoded_gaps""",
    ),
    "decode_ids_large_vocab": with_parts(
        "pairs", f"""SELECT id, array_to_string({words("coalesce(article, 'nan')")}[1:511], ' ') AS text FROM pairs"""
    ),
    "dash_runs": with_parts(
        "pairs",
        f"""SELECT id, {clean("replace(article, ' ', CASE WHEN id % 3 = 0 THEN ' --- ' ELSE '--' END)")} AS article FROM pairs""",
    ),
    "clean_text": with_parts(
        "pairs", f"SELECT id, split, {clean('article')} AS article, {clean('highlights')} AS highlights FROM pairs"
    ),
    "length_filter": with_parts("pairs filled", f"SELECT * FROM filled WHERE {FITS}"),
    "preprocess_rows": with_parts("pairs filled firsts cleaned_firsts processed", "SELECT * FROM processed"),
    "processed_roundtrip": with_parts("pairs filled firsts cleaned_firsts processed", "SELECT * FROM processed"),
    "preprocess_counts": with_parts(
        "pairs filled firsts cleaned_firsts processed", "SELECT split, count(*) AS num_rows FROM processed GROUP BY split"
    ),
    "step_row_counts": with_parts(
        "pairs filled firsts cleaned_firsts processed",
        """
        , c AS (SELECT (SELECT count(*) FROM pairs) AS a, (SELECT count(*) FROM filled) AS b,
                       (SELECT count(*) FROM firsts) AS d, (SELECT count(*) FROM processed) AS e)
        SELECT 'drop_na' AS step, a AS rows_before, b AS rows_after FROM c
        UNION ALL SELECT 'drop_duplicates', b, d FROM c
        UNION ALL SELECT 'text_cleaning', d, d FROM c
        UNION ALL SELECT 'length_filter', d, e FROM c""",
    ),
    "overview": with_parts(
        "pairs",
        """SELECT count(*) AS num_rows, CAST(4 AS BIGINT) AS num_columns,
                  CAST(sum(strlen(split)) + sum(strlen(article)) + sum(strlen(highlights)) AS BIGINT) AS text_bytes
           FROM pairs""",
    ),
    "missing_values": with_parts(
        "pairs",
        """
        , c AS (SELECT 'id' AS column_name, count(*) - count(id) AS n_missing FROM pairs
                UNION ALL SELECT 'split', count(*) - count(split) FROM pairs
                UNION ALL SELECT 'article', count(*) - count(article) FROM pairs
                UNION ALL SELECT 'highlights', count(*) - count(highlights) FROM pairs)
        SELECT * FROM c WHERE n_missing > 0
        UNION ALL SELECT 'missing', 0 WHERE NOT EXISTS (SELECT 1 FROM c WHERE n_missing > 0)""",
    ),
    "duplicate_counts": with_parts(
        "pairs",
        """
        SELECT (SELECT count(*) FROM pairs) - (SELECT count(*) FROM (SELECT DISTINCT article FROM pairs)) AS duplicate_articles,
               (SELECT count(*) FROM pairs) - (SELECT count(*) FROM (SELECT DISTINCT highlights FROM pairs)) AS duplicate_summaries,
               (SELECT count(*) FROM pairs) - (SELECT count(*) FROM (SELECT DISTINCT article, highlights FROM pairs)) AS duplicate_pairs""",
    ),
    "length_stats": with_parts(
        "pairs lengths",
        " UNION ALL ".join(stats(m) for m in ("article_chars", "summary_chars", "article_words", "summary_words")),
    ),
    "compression_ratio": with_parts(
        "pairs lengths",
        """SELECT round(coalesce(avg(summary_words / article_words) FILTER (article_words > 0), 0), 6)
                  AS compression_ratio_mean FROM lengths""",
    ),
    "empty_counts": with_parts(
        "pairs lengths",
        """SELECT count(*) FILTER (article_words = 0) AS empty_articles,
                  count(*) FILTER (summary_words = 0) AS empty_summaries FROM lengths""",
    ),
    "row_counts": with_parts("pairs", "SELECT count(*) AS num_rows FROM pairs"),
    "split_sizes": with_parts("pairs", "SELECT split, count(*) AS num_rows FROM pairs GROUP BY split"),
    "split_inspection": with_parts(
        "pairs nan_words",
        """SELECT split, count(*) AS num_rows, round(avg(article), 6) AS avg_article_words,
                  round(avg(summary), 6) AS avg_summary_words FROM nan_words GROUP BY split""",
    ),
    "length_histogram": with_parts("pairs nan_words", f"{histogram('article')} UNION ALL {histogram('summary')}"),
    "non_empty_articles": with_parts("pairs", f"SELECT * FROM pairs WHERE {word_count('article', '')} > 0"),
    "sample_exact": with_parts("pairs", sampled("pairs", 500)),
    "load_subset_dev": with_parts(
        "pairs",
        """SELECT id, split, article, highlights FROM pairs
           QUALIFY row_number() OVER (PARTITION BY split ORDER BY md5('42:' || id), id)
                   <= CASE split WHEN 'train' THEN 500 ELSE 100 END""",
    ),
    "token_counts": with_parts("pairs nan_words", token_stats(f"({sampled('nan_words', 5000)})")),
    "token_counts_all": with_parts("pairs nan_words", token_stats("nan_words")),
    "sample_pairs": with_parts(
        "pairs",
        f"""SELECT id, substr(coalesce(article, 'nan'), 1, 500) AS article, coalesce(highlights, 'nan') AS summary
            FROM ({sampled('pairs', 5)})""",
    ),
    "scatter_sample": with_parts(
        "pairs nan_words",
        f"SELECT id, article AS article_words, summary AS summary_words FROM ({sampled('nan_words', 5000)})",
    ),
    "top_words": with_parts(
        "pairs counted",
        """SELECT term, count(*) AS n FROM (SELECT unnest(w) AS term FROM counted)
           GROUP BY term ORDER BY n DESC, term LIMIT 30""",
    ),
    "top_ngrams": with_parts(
        "pairs counted",
        f"""SELECT term, count(*) AS n FROM (
              SELECT unnest({grams(2, 'w')}) AS term FROM counted UNION ALL SELECT unnest({grams(3, 'w')}) FROM counted)
            GROUP BY term ORDER BY n DESC, term LIMIT 30""",
    ),
    "summarize_lead": with_parts(
        "pairs",
        f"""SELECT id, array_to_string(list_slice({sentences("coalesce(article, '')")}, 1, 3), ' ') AS generated_summary
            FROM pairs""",
    ),
    "summarize_extractive": with_parts(
        EXTRACTIVE_PARTS,
        """SELECT p.id, coalesce(g.generated_summary, '') AS generated_summary
           FROM pairs p LEFT JOIN (SELECT id, string_agg(sentence, ' ' ORDER BY pos) AS generated_summary
                                   FROM ranked_sentences WHERE place <= 3 GROUP BY id) g USING (id)""",
    ),
    "summarize_table": with_parts(
        EXTRACTIVE_PARTS.replace("sentence_rows", "prefixed_rows"),
        """SELECT p.id, p.split, coalesce(g.sentence, '') AS generated_summary
           FROM pairs p LEFT JOIN (SELECT * FROM ranked_sentences WHERE place = 1) g USING (id)""",
    ).replace("prefixed_rows AS", "sentence_rows AS"),
    "generation_length_stats": with_parts(
        LEAD_PARTS,
        f"""SELECT round(avg(w), 6) AS mean_words, min(w) AS min_words, max(w) AS max_words
            FROM (SELECT {word_count('generated_summary', '')} AS w FROM lead)""",
    ),
    "predictions_vs_references": with_parts(
        LEAD_PARTS, "SELECT id, substr(article, 1, 300) AS article, reference_summary, generated_summary FROM lead"
    ),
    "rouge1_rows": scores_of(LEAD_PARTS, plain_tokens("lead"), ngram_scores(1), body=rounded_scores("scores1")),
    "rouge2_rows": scores_of(LEAD_PARTS, plain_tokens("lead"), ngram_scores(2), body=rounded_scores("scores2")),
    "stem_map": scores_of(
        "pairs",
        f"seen AS (SELECT DISTINCT token FROM (SELECT unnest({rouge_tokens('article')}) AS token FROM pairs))",
        stem_parts("seen"),
        body="SELECT token, stem FROM stems",
    ),
    "rouge1_stem_rows": scores_of(LEAD_PARTS, stemmed_tokens("lead"), ngram_scores(1), body=rounded_scores("scores1")),
    "rouge_l_rows": scores_of(LEAD_PARTS, stemmed_tokens("lead"), LCS_SCORES, body=rounded_scores("scoresL"), recursive=True),
    "rouge_rows": scores_of(
        "pairs optional_lead", stemmed_tokens("optional_lead"), ngram_scores(1), ngram_scores(2), LCS_SCORES, recursive=True,
        body="""SELECT a.id, round(100 * s1.f1, 4) AS "rouge1", round(100 * s2.f1, 4) AS "rouge2",
                       round(100 * l.f1, 4) AS "rougeL", round(100 * l.f1, 4) AS "rougeLsum"
                FROM optional_lead a LEFT JOIN scores1 s1 USING (id) LEFT JOIN scores2 s2 USING (id)
                     LEFT JOIN scoresL l USING (id)""",
    ),
    "rouge_corpus": scores_of(
        LEAD_PARTS, stemmed_tokens("lead"), ngram_scores(1), ngram_scores(2), LCS_SCORES, recursive=True,
        body=f"SELECT {CORPUS}",
    ),
    "evaluate": scores_of(
        LEAD_PARTS, stemmed_tokens("lead"), ngram_scores(1), ngram_scores(2), LCS_SCORES, recursive=True,
        body=f"""SELECT {CORPUS}, round(avg(w), 6) AS mean_words, min(w) AS min_words, max(w) AS max_words
                 FROM (SELECT {word_count('generated_summary', '')} AS w FROM lead)""",
    ),
    "evaluate_table": scores_of(
        "pairs filled firsts cleaned_firsts processed",
        "best AS (SELECT * FROM processed WHERE split = 'test')",
        *(f"{n} AS ({PARTS[n].replace('FROM pairs', 'FROM best')})" for n in EXTRACTIVE_PARTS.split()[1:]),
        """chosen AS (SELECT b.id, b.highlights AS reference_summary, coalesce(g.s, '') AS generated_summary
           FROM best b LEFT JOIN (SELECT id, string_agg(sentence, ' ' ORDER BY pos) AS s
                                  FROM ranked_sentences WHERE place <= 3 GROUP BY id) g USING (id))""",
        stemmed_tokens("chosen"), ngram_scores(1), ngram_scores(2), LCS_SCORES, recursive=True,
        body=f"""SELECT {CORPUS}, round(avg(w), 6) AS mean_words, min(w) AS min_words, max(w) AS max_words
                 FROM (SELECT {word_count('generated_summary', '')} AS w FROM chosen)""",
    ),
    "rouge1_turn_rows": "WITH turns AS (SELECT concat_ws('-', a.conv_id, a.turn) AS id, a.text AS reference_summary, "
    "b.text AS generated_summary FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id "
    "AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'),"
    + plain_tokens("turns") + "," + ngram_scores(1) + "\n" + rounded_scores("scores1"),
    "rouge_corpus_nostem": scores_of(
        LEAD_PARTS, plain_tokens("lead"), ngram_scores(1), ngram_scores(2),
        body="""SELECT (SELECT round(100 * avg(f1), 4) FROM scores1) AS rouge1,
                       (SELECT round(100 * avg(f1), 4) FROM scores2) AS rouge2""",
    ),
    "build_vocab": with_parts("pairs vocab_counts vocab", "SELECT token, token_id, n FROM vocab"),
    "encode_pairs": with_parts(
        ENCODE_PARTS,
        f"""SELECT id, array_to_string(input_ids, ',') AS input_ids,
                   array_to_string([CASE WHEN x = 0 THEN 0 ELSE 1 END FOR x IN input_ids], ',') AS attention_mask,
                   array_to_string({MASKED}, ',') AS labels
            FROM encoded""",
    ),
    "label_mask": with_parts(ENCODE_PARTS, f"SELECT id, array_to_string({MASKED}, ',') AS labels FROM encoded"),
    "decode_ids": with_parts(
        ENCODE_PARTS,
        """SELECT e.id, coalesce(g.text, '') AS text FROM encoded e LEFT JOIN (
             SELECT id, string_agg(token, ' ' ORDER BY pos) AS text
             FROM (SELECT id, unnest(targets) AS token_id, generate_subscripts(targets, 1) AS pos FROM encoded)
             JOIN vocab USING (token_id) GROUP BY id) g USING (id)""",
    ),
    "truncation_report": with_parts(
        "pairs",
        f"""SELECT split,
                   round(avg(CASE WHEN {word_count("'summarize: ' || coalesce(article, 'nan')", '')} > 511 THEN 1.0 ELSE 0.0 END), 6)
                     AS article_truncated,
                   round(avg(CASE WHEN {word_count('highlights', 'nan')} > 127 THEN 1.0 ELSE 0.0 END), 6) AS summary_truncated
            FROM pairs GROUP BY split""",
    ),
    "greedy_match_score": "WITH" + MATCH_PARTS + """
        SELECT id, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM matched""",
    "greedy_match_corpus": "WITH" + MATCH_PARTS + """
        SELECT round(avg(precision), 4) AS match_precision, round(avg(recall), 4) AS match_recall,
               round(avg(f1), 4) AS match_f1 FROM matched""",
    "report_rows": with_parts(
        "pairs lengths nan_words counted",
        """
        , toks AS (SELECT * FROM nan_words ORDER BY md5('42:' || id), id LIMIT 5000)
        SELECT 'totals' AS section, 'num_rows' AS key, CAST(count(*) AS VARCHAR) AS value FROM pairs
        UNION ALL SELECT 'duplicates', 'duplicate_articles', CAST((SELECT count(*) FROM pairs) - count(*) AS VARCHAR)
                  FROM (SELECT DISTINCT article FROM pairs)
        UNION ALL SELECT 'duplicates', 'duplicate_summaries', CAST((SELECT count(*) FROM pairs) - count(*) AS VARCHAR)
                  FROM (SELECT DISTINCT highlights FROM pairs)
        UNION ALL SELECT 'duplicates', 'duplicate_pairs', CAST((SELECT count(*) FROM pairs) - count(*) AS VARCHAR)
                  FROM (SELECT DISTINCT article, highlights FROM pairs)
        UNION ALL SELECT 'lengths', 'article_words_mean', printf('%.6f', avg(article_words)) FROM lengths
        UNION ALL SELECT 'lengths', 'summary_words_mean', printf('%.6f', avg(summary_words)) FROM lengths
        UNION ALL SELECT 'lengths', 'compression_ratio_mean',
                         printf('%.6f', avg(summary_words / article_words) FILTER (article_words > 0)) FROM lengths
        UNION ALL SELECT 'tokens', 'article_tokens_p95', printf('%.6f', quantile_cont(article, 0.95)) FROM toks
        UNION ALL SELECT 'tokens', 'summary_tokens_p95', printf('%.6f', quantile_cont(summary, 0.95)) FROM toks
        UNION ALL (SELECT 'top_words', term, CAST(count(*) AS VARCHAR) FROM (SELECT unnest(w) AS term FROM counted)
                   GROUP BY term ORDER BY count(*) DESC, term LIMIT 15)
        UNION ALL SELECT 'splits', split, CAST(count(*) AS VARCHAR) FROM pairs GROUP BY split""",
    ),
}

ORACLES["summarize_csv_roundtrip"] = ORACLES["summarize_extractive"]
ORACLES["evaluate_table_subset"] = ORACLES["evaluate_table"].replace(
    "SELECT * FROM processed WHERE split = 'test'", sampled("processed WHERE split = 'test'", 20)
)


def report_lines(section: str, key: str, value: str, source: str, floating: bool = False) -> str:
    shown = f"printf('%.6f', {value})" if floating else f"CAST({value} AS VARCHAR)"
    return f"SELECT '{section}' AS section, {key} AS key, {shown} AS value FROM {source}"


def _length_lines(metric: str) -> list[str]:
    numbers = {
        "mean": f"avg({metric})", "median": f"quantile_cont({metric}, 0.5)", "std": f"stddev_pop({metric})",
        "p90": f"quantile_cont({metric}, 0.9)", "p95": f"quantile_cont({metric}, 0.95)", "p99": f"quantile_cont({metric}, 0.99)",
    }
    lines = [report_lines("length_distribution", f"'{metric}.{k}'", v, "lengths", True) for k, v in numbers.items()]
    return lines + [report_lines("length_distribution", f"'{metric}.{k}'", f"{k}({metric})", "lengths") for k in ("min", "max")]


def _duplicate_line(kind: str, columns: str) -> str:
    return report_lines("duplicates", f"'duplicate_{kind}'", "(SELECT count(*) FROM pairs) - count(*)", f"(SELECT DISTINCT {columns} FROM pairs)")


def _top_lines(section: str, tokens: str) -> str:
    return f"""(SELECT '{section}' AS section, term || '.n' AS key, CAST(count(*) AS VARCHAR) AS value FROM ({tokens})
               GROUP BY term ORDER BY count(*) DESC, term LIMIT 30)"""


REPORT_LINES = [
    report_lines("num_total_rows", "''", "count(*)", "pairs"),
    report_lines("overview", "'num_rows'", "count(*)", "pairs"),
    report_lines("overview", "'num_columns'", "4", "(SELECT 1)"),
    report_lines("overview", "'text_bytes'", "sum(strlen(split)) + sum(strlen(article)) + sum(strlen(highlights))", "pairs"),
    *(
        f"SELECT * FROM ({report_lines('missing_values', f"'{c}.n_missing'", f'count(*) - count({c})', 'pairs')}) WHERE value <> '0'"
        for c in ("id", "split", "article", "highlights")
    ),
    report_lines("missing_values", "'missing.n_missing'", "0", "(SELECT 1) WHERE NOT EXISTS (SELECT 1 FROM pairs WHERE "
                 "id IS NULL OR split IS NULL OR article IS NULL OR highlights IS NULL)"),
    *(_duplicate_line(k, c) for k, c in (("articles", "article"), ("summaries", "highlights"), ("pairs", "article, highlights"))),
    *(line for m in ("article_chars", "summary_chars", "article_words", "summary_words") for line in _length_lines(m)),
    report_lines("length_totals", "'num_rows'", "count(*)", "lengths"),
    report_lines("length_totals", "'article_words_mean'", "avg(article_words)", "lengths", True),
    report_lines("length_totals", "'summary_words_mean'", "avg(summary_words)", "lengths", True),
    report_lines("length_totals", "'compression_ratio_mean'",
                 "coalesce(avg(summary_words / article_words) FILTER (article_words > 0), 0)", "lengths", True),
    report_lines("length_totals", "'empty_articles'", "count(*) FILTER (article_words = 0)", "lengths"),
    report_lines("length_totals", "'empty_summaries'", "count(*) FILTER (summary_words = 0)", "lengths"),
    report_lines("token_counts", "'sample_size'", "count(*)", "nan_words"),
    *(
        report_lines("token_counts", f"'{side}_tokens_{k}'", v.format(side), "nan_words", True)
        for side in ("article", "summary") for k, v in (("mean", "avg({})"), ("p95", "quantile_cont({}, 0.95)"))
    ),
    _top_lines("top_words", "SELECT unnest(w) AS term FROM counted"),
    _top_lines("top_ngrams", f"SELECT unnest({grams(2, 'w')}) AS term FROM counted UNION ALL SELECT unnest({grams(3, 'w')}) FROM counted"),
    report_lines("split_inspection", "split || '.num_rows'", "count(*)", "nan_words GROUP BY split"),
    report_lines("split_inspection", "split || '.avg_article_words'", "avg(article)", "nan_words GROUP BY split", True),
    report_lines("split_inspection", "split || '.avg_summary_words'", "avg(summary)", "nan_words GROUP BY split", True),
    report_lines("sample_pairs", "id || '.article'", "substr(coalesce(article, 'nan'), 1, 500)", f"({sampled('pairs', 5)})"),
    report_lines("sample_pairs", "id || '.summary'", "coalesce(highlights, 'nan')", f"({sampled('pairs', 5)})"),
]

NULL_TEXTS = (
    "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', "
    "'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
)

# Cumulative probabilities of a Poisson law of mean 1: 1/e times the sum of 1/k! up to k.
_POISSON = [f"exp(-1) * ({' + '.join(f'1.0 / factorial({i})' for i in range(k + 1))})" for k in range(10)]
INTERVAL_PARTS = f"""
    digests AS (SELECT rs.k, s1.id, s1.f1 AS f1, s2.f1 AS f2,
                       CAST('0x' || substr(md5(rs.k || ':' || s1.id), 1, 8) AS BIGINT) / 4294967296.0 AS u
                FROM scores1 s1 JOIN scores2 s2 ON s1.id = s2.id CROSS JOIN range(1, 101) rs(k)),
    drawn AS (SELECT *, {' + '.join(f'CAST(u >= {p} AS BIGINT)' for p in _POISSON)} AS w FROM digests),
    means AS (SELECT k, sum(w * f1) / sum(w) AS f1, sum(w * f2) / sum(w) AS f2 FROM drawn GROUP BY k)"""


def interval_row(name: str, column: str) -> str:
    at = [f"round(100 * quantile_cont({column}, {q}), 4)" for q in (0.025, 0.5, 0.975)]
    return f"SELECT '{name}' AS score, {at[0]} AS low, {at[1]} AS mid, {at[2]} AS high FROM means"


ORACLES |= {
    "eda_report": with_parts("pairs lengths nan_words counted", " UNION ALL ".join(REPORT_LINES)),
    "sample_exact_many_ids": with_parts(
        "pairs", "SELECT id FROM (SELECT unnest(range(id * 400, id * 400 + 400)) AS id FROM pairs) ORDER BY md5('42:' || id), id LIMIT 1000"
    ),
    "predictor_throughput": with_parts(
        "pairs",
        """SELECT id % 8 AS task, count(*) AS num_rows, (count(*) + 15) // 16 AS num_batches, CAST(1 AS BIGINT) AS measured
           FROM pairs GROUP BY id % 8""",
    ),
    "run_step_counts": ORACLES["step_row_counts"],
    "rouge_interval": scores_of(
        LEAD_PARTS, plain_tokens("lead"), ngram_scores(1), ngram_scores(2), INTERVAL_PARTS,
        body=f"{interval_row('rouge1', 'f1')} UNION ALL {interval_row('rouge2', 'f2')}",
    ),
    "preprocess_stream": with_parts("pairs filled cleaned", f"SELECT id, split, article, highlights FROM cleaned WHERE {FITS}"),
    "split_leakage": with_parts(
        "pairs filled cleaned",
        """
        , d AS (SELECT DISTINCT split, article, highlights FROM cleaned),
        n AS (SELECT a.split AS split_a, b.split AS split_b, count(*) AS n_pairs
              FROM d a JOIN d b ON a.article = b.article AND a.highlights = b.highlights GROUP BY ALL)
        SELECT s.a AS split_a, s.b AS split_b, coalesce(n_pairs, 0) AS n_pairs
        FROM (VALUES ('train', 'validation'), ('train', 'test'), ('validation', 'test')) s(a, b)
             LEFT JOIN n ON n.split_a = s.a AND n.split_b = s.b""",
    ),
    "top_words_first_seen": with_parts(
        "pairs counted",
        """SELECT term, count(*) AS n FROM (SELECT id, unnest(w) AS term, generate_subscripts(w, 1) AS i FROM counted)
           GROUP BY term ORDER BY n DESC, min({'id': id, 'i': i}) LIMIT 30""",
    ),
    "csv_quarantine": with_parts(
        "pairs",
        f"""SELECT 'row' AS kind, id || ',' || split || ',' || CASE WHEN highlights IS NULL OR highlights IN {NULL_TEXTS} THEN '-'
                   ELSE highlights END AS value FROM pairs WHERE id % 7 > 1
            UNION ALL SELECT 'line', id || ',' || split || ',' || coalesce('"' || replace(highlights, '"', '""') || '"', '') || ',more'
                      FROM pairs WHERE id % 7 = 0
            UNION ALL SELECT 'line', id || ',"' || split || ',' || replace(coalesce(highlights, ''), '"', '') FROM pairs WHERE id % 7 = 1""",
    ),
    "read_text_folder": with_parts(
        "pairs",
        """SELECT split, CAST(sum(length(highlights) + 1) AS BIGINT) AS num_chars, count(*) AS num_lines, CAST(0 AS BIGINT) AS odd_names
           FROM pairs WHERE highlights IS NOT NULL GROUP BY split""",
    ),
    "report_json": with_parts(
        "pairs lengths",
        """SELECT count(*) AS num_rows, count(*) FILTER (article_words = 0) AS empty_articles,
                  count(*) FILTER (summary_words = 0) AS empty_summaries FROM lengths""",
    ),
    "summarize_single": scores_of(
        "pairs",
        f"best AS (SELECT id, split, {clean('article')} AS article, {clean('highlights')} AS highlights FROM pairs)",
        *(f"{n} AS ({PARTS[n].replace('FROM pairs', 'FROM best')})" for n in EXTRACTIVE_PARTS.split()[1:]),
        """chosen AS (SELECT b.id, nullif(b.highlights, '') AS reference_summary, coalesce(g.s, '') AS generated_summary
           FROM best b LEFT JOIN (SELECT id, string_agg(sentence, ' ' ORDER BY pos) AS s
                                  FROM ranked_sentences WHERE place <= 3 GROUP BY id) g USING (id))""",
        stemmed_tokens("chosen"), ngram_scores(1), ngram_scores(2), LCS_SCORES, recursive=True,
        body="""SELECT c.id, c.generated_summary, round(100 * s1.f1, 4) AS "rouge1", round(100 * s2.f1, 4) AS "rouge2",
                       round(100 * l.f1, 4) AS "rougeL"
                FROM chosen c LEFT JOIN scores1 s1 USING (id) LEFT JOIN scores2 s2 USING (id) LEFT JOIN scoresL l USING (id)""",
    ),
    "user_extensions": with_parts(
        "pairs",
        rf"""
        , kept AS (SELECT length(coalesce(article, '')) AS ac, length(coalesce(highlights, '')) AS sc,
                          len(regexp_extract_all(coalesce(article, 'nan'), '[A-Za-z]+')) AS "at",
                          len(regexp_extract_all(coalesce(highlights, 'nan'), '[A-Za-z]+')) AS st
                   FROM pairs WHERE {word_count('article', '')} > 3)
        SELECT 'tokens' AS section, 'article' AS key, CAST(sum("at") AS VARCHAR) AS value FROM kept
        UNION ALL SELECT 'tokens', 'summary', CAST(sum(st) AS VARCHAR) FROM kept
        UNION ALL SELECT 'longest', 'article', CAST(max(ac) AS VARCHAR) FROM kept
        UNION ALL SELECT 'longest', 'summary', CAST(max(sc) AS VARCHAR) FROM kept""",
    ),
    "length_stats_empty": with_parts(
        "pairs lengths",
        " UNION ALL ".join(
            stats(m).replace("FROM lengths", "FROM (SELECT * FROM lengths WHERE id < 0)")
            for m in ("article_chars", "summary_chars", "article_words", "summary_words")
        ),
    ),
}
