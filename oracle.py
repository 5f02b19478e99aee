"""SQL that gives the same answers as the queries, for DuckDB on the same tables.

The statements are put together from common table expressions. They follow the definitions step
by step (each sentence on its own, dense scores, explicit joins) where the Spark side takes
shorter ways, so that the two can disagree.
"""

from __future__ import annotations

import math
import re

from tonewright.functions.stem import STEP2_SUFFIXES, STEP3_SUFFIXES, STEP4_SUFFIXES
from tonewright.functions.wordlists import (
    CONTRACTIONS,
    IRREGULAR_STEMS,
    PUNCTUATION,
    SPACED_CONTRACTION,
    STOP_WORDS,
)

Ctes = list[tuple[str, str]]

_PUNCT = "[" + re.escape(PUNCTUATION).replace("'", "''") + "]"
_SPACE = r"[ \t\n\x0B\f\r]+"
_GAP = (
    r"[ \t\n\x0B\f\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _sql(ctes: Ctes, final: str) -> str:
    body = ",\n".join(f"{name} AS MATERIALIZED ({query})" for name, query in ctes)
    return f"WITH {body}\n{final}"


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


# --- text ---------------------------------------------------------------------------------------

_STEPS = (
    ("no_markup", r"<[^\n]*?>"),
    ("no_digits", "[0-9]+"),
    ("no_punctuation", _PUNCT),
    ("one_space", _SPACE),
)


def _clean(column: str) -> str:
    for _, pattern in _STEPS:
        column = f"regexp_replace({column}, '{pattern}', ' ', 'g')"
    return column


_LABELED = """SELECT d.doc_id, d.text, CAST(l.quality AS DOUBLE) AS label
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""
_EVERY = """SELECT d.doc_id, d.text, CAST(l.quality AS DOUBLE) AS label
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _words(sentence: str) -> str:
    s = f"replace(lower({sentence}), '...', ' ... ')"
    s = rf"regexp_replace({s}, '(^|[^.])[.] *$', '\1 . ')"
    s = rf"regexp_replace({s}, '([?!])', ' \1 ', 'g')"
    for a, b in CONTRACTIONS:
        s = rf"regexp_replace({s}, '\b({a})({b})\b', '\1 \2', 'g')"
    a, b = SPACED_CONTRACTION
    s = rf"regexp_replace({s}, '\b({a})({b})(\s|$)', '\1 \2\3', 'g')"
    return f"list_filter(string_split_regex({s}, '{_GAP}'), lambda x: x <> '')"


def _token_ctes(source: str) -> Ctes:
    return [
        ("docs", source),
        ("cleaned", f"SELECT doc_id, {_clean('text')} AS c FROM docs"),
        (
            "parts",
            r"SELECT doc_id, string_split(regexp_replace(c, '([.?!]) ', '\1' || chr(10), 'g'), "
            "chr(10)) AS p FROM cleaned",
        ),
        (
            "sents",
            "SELECT doc_id, generate_subscripts(p, 1) AS spos, unnest(p) AS s FROM parts",
        ),
        ("split_sents", f"SELECT doc_id, spos, {_words('s')} AS ws FROM sents"),
        (
            "toks",
            "SELECT doc_id, spos, generate_subscripts(ws, 1) AS pos, unnest(ws) AS t "
            "FROM split_sents",
        ),
        ("kept", f"SELECT * FROM toks WHERE t NOT IN ({_quoted(STOP_WORDS)})"),
    ]


def _plain_ctes(source: str) -> Ctes:
    return [
        ("docs", source),
        ("cleaned", f"SELECT doc_id, {_clean('text')} AS c FROM docs"),
        (
            "split_docs",
            "SELECT doc_id, string_split(regexp_replace(lower(c), '[?!.]+', '', 'g'), ' ') AS ws "
            "FROM cleaned",
        ),
        (
            "toks",
            "SELECT doc_id, 1 AS spos, generate_subscripts(ws, 1) AS pos, unnest(ws) AS t "
            "FROM split_docs",
        ),
        (
            "kept",
            f"SELECT * FROM toks WHERE t <> '' AND t NOT IN ({_quoted(STOP_WORDS)})",
        ),
    ]


# --- stems --------------------------------------------------------------------------------------

_VOWEL = "^([^aeiou][^aeiouy]*[aeiouy]|[aeiou])"
_M1 = _VOWEL + "[aeiou]*[^aeiou]"
_M2 = _M1 + "[^aeiouy]*[aeiouy][aeiou]*[^aeiou]"
_M1_ONLY = _M1 + "[^aeiouy]*([aeiouy][aeiou]*)?$"
_CVC = "^([^aeiou][^aeiouy]*[aeiouy][^aeiouwxy]|[aeiou][^aeiou])$"


def _has(word: str, pattern: str) -> str:
    return f"regexp_matches({word}, '{pattern}')"


def _left(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _case(*branches: tuple[str, str]) -> str:
    whens = " ".join(f"WHEN {test} THEN {value}" for test, value in branches)
    return f"CASE {whens} ELSE w END"


def _ends(suffix: str) -> str:
    return f"ends_with(w, '{suffix}')"


def _if(test: str, value: str) -> str:
    return f"CASE WHEN {test} THEN {value} ELSE w END"


def _swap(suffix: str, new: str, pattern: str) -> tuple[str, str]:
    rest = _left(len(suffix))
    return _ends(suffix), _if(_has(rest, pattern), f"{rest} || '{new}'")


def _by_length(word: str) -> str:
    return f"CASE WHEN length(w) = 4 THEN {_left(1)} ELSE {_left(2)} END"


def _stem_steps() -> list[str]:
    alli = [
        (f"{_ends('ationalli')} AND {_has(_left(9), _M1)}", f"{_left(9)} || 'ate'"),
        (
            f"{_ends('tionalli')} AND NOT {_ends('ationalli')} AND {_has(_left(8), _M1)}",
            f"{_left(8)} || 'tion'",
        ),
        (_ends("alli"), _if(_has(_left(4), _M1), _left(2))),
    ]
    doubled = (
        "right(w, 2) = repeat(right(w, 1), 2) AND length(w) > 1 AND "
        "(right(w, 1) NOT IN ('a','e','i','o','u','y') OR regexp_matches(w, '[^aeiouy]yy$'))"
    )
    return [
        _case(
            (_ends("sses"), _left(2)),
            (_ends("ies"), _by_length("w")),
            (f"{_ends('s')} AND NOT {_ends('ss')}", _left(1)),
        ),
        # "#" marks a cut "ed" or "ing" for the next step.
        _case(
            (_ends("ied"), _by_length("w")),
            (_ends("eed"), _if(_has(_left(3), _M1), _left(1))),
            (f"{_ends('ed')} AND {_has(_left(2), _VOWEL)}", f"{_left(2)} || '#'"),
            (f"{_ends('ing')} AND {_has(_left(3), _VOWEL)}", f"{_left(3)} || '#'"),
        ),
        "CASE WHEN NOT ends_with(w0, '#') THEN w0 "
        "WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e' "
        f"WHEN {doubled} THEN CASE WHEN right(w, 1) IN ('l', 's', 'z') THEN w ELSE {_left(1)} END "
        f"WHEN {_has('w', _CVC)} THEN w || 'e' ELSE w END",
        _case(
            (
                "length(w) > 2 AND regexp_matches(w, '([^aeiouy]|[aeiou]y)y$')",
                f"{_left(1)} || 'i'",
            )
        ),
        _case(
            *alli,
            (_ends("logi"), _if(_has(_left(3), _M1), _left(1))),
            *(_swap(s, n, _M1) for s, n in STEP2_SUFFIXES.items()),
        ),
        _case(*(_swap(s, n, _M1) for s, n in STEP3_SUFFIXES.items())),
        _case(
            *(_swap(s, "", _M2) for s in STEP4_SUFFIXES),
            (f"{_ends('sion')} OR {_ends('tion')}", _if(_has(_left(3), _M2), _left(3))),
        ),
        _case(
            (
                f"{_ends('e')} AND ({_has(_left(1), _M2)} OR "
                f"({_has(_left(1), _M1_ONLY)} AND NOT {_has(_left(1), _CVC)}))",
                _left(1),
            )
        ),
        _case((f"{_ends('ll')} AND {_has('w', _M2)}", _left(1))),
    ]


def _stem_ctes() -> Ctes:
    ctes: Ctes = [("stem0", "SELECT DISTINCT t, t AS w FROM kept")]
    for i, step in enumerate(_stem_steps(), 1):
        source = f"stem{i - 1}"
        if i == 3:
            source = f"(SELECT t, w AS w0, rtrim(w, '#') AS w FROM {source})"
        ctes.append((f"stem{i}", f"SELECT t, {step} AS w FROM {source}"))
    own = " ".join(f"WHEN '{w}' THEN '{s}'" for w, s in IRREGULAR_STEMS.items())
    ctes.append(
        (
            "stems",
            f"SELECT t, CASE WHEN length(t) <= 2 THEN t ELSE CASE t {own} ELSE w END END AS stem "
            f"FROM stem{len(_stem_steps())}",
        )
    )
    return ctes


def _term_ctes(source: str, analyze: str = "unigram") -> Ctes:
    ctes = _plain_ctes(source) if analyze == "plain" else _token_ctes(source)
    ctes = ctes + _stem_ctes()
    stemmed = (
        "SELECT doc_id, spos, pos, stem AS term FROM kept JOIN stems ON kept.t = stems.t "
        "WHERE stem <> ''"
    )
    if analyze != "bigram":
        return [*ctes, ("terms", stemmed)]
    pair = (
        "SELECT doc_id, spos, pos, term || ' ' || lead(term) OVER "
        "(PARTITION BY doc_id, spos ORDER BY pos) AS term FROM single_terms"
    )
    return [
        *ctes,
        ("single_terms", stemmed),
        ("terms", f"SELECT * FROM ({pair}) WHERE term IS NOT NULL"),
    ]


def _listed(table: str, column: str, count: str, name: str) -> str:
    return (
        f"SELECT docs.doc_id, CAST(count(x.{column}) AS INTEGER) AS {count}, "
        f"coalesce(string_agg(x.{column}, '|' ORDER BY spos, pos), '') AS {name} "
        f"FROM docs LEFT JOIN {table} x ON docs.doc_id = x.doc_id GROUP BY docs.doc_id"
    )


def _collocations() -> str:
    ctes = _term_ctes(_EVERY)
    nexts = (
        "SELECT term AS a, lead(term) OVER (PARTITION BY doc_id, spos ORDER BY pos) AS b FROM terms"
    )
    ctes += [
        ("nexts", nexts),
        ("n_pairs", "SELECT a, b, count(*) AS n FROM nexts WHERE b IS NOT NULL GROUP BY a, b"),
        ("n_terms", "SELECT term, count(*) AS n FROM terms GROUP BY term"),
        (
            "cells",
            "SELECT a, b, p.n AS n_pair, CAST(p.n AS DOUBLE) AS n11, "
            "CAST(x.n - p.n AS DOUBLE) AS n12, CAST(y.n - p.n AS DOUBLE) AS n21, "
            "CAST((SELECT count(*) FROM terms) AS DOUBLE) AS total "
            "FROM n_pairs p JOIN n_terms x ON p.a = x.term JOIN n_terms y ON p.b = y.term",
        ),
        ("table4", "SELECT *, total - n11 - n12 - n21 AS n22 FROM cells"),
        (
            "scored",
            "SELECT a, b, n_pair, (n11 + n12) * (n11 + n21) * (n12 + n22) * (n21 + n22) AS m, "
            "total * ((n11 * n22 - n12 * n21) * (n11 * n22 - n12 * n21)) AS top FROM table4",
        ),
        (
            "rounded",
            "SELECT a, b, n_pair, round(CASE WHEN m = 0 THEN 0 ELSE top / m END, 6) AS chi_square "
            "FROM scored",
        ),
    ]
    return _sql(
        ctes,
        "SELECT a || ' ' || b AS bigram, n_pair, chi_square FROM rounded "
        "ORDER BY chi_square DESC, a, b LIMIT 300",
    )


# --- TF-IDF -------------------------------------------------------------------------------------


def _bucket(key: str, k: int) -> str:
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % {k})"


_TRAIN = f"{_bucket('doc_id', 100)} < 60"


def _weight_ctes(
    source: str = _LABELED, analyze: str = "unigram", fit: str = "label IS NOT NULL"
) -> Ctes:
    """Weights ``w`` of all documents, with the vocabulary of those that ``fit`` selects."""
    return [
        *_term_ctes(source, analyze),
        ("tf", "SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term"),
        ("fitted", f"SELECT doc_id FROM docs WHERE {fit}"),
        (
            "vocab",
            "SELECT term, count(*) AS df, "
            "ln((1.0 + (SELECT count(*) FROM fitted)) / (1.0 + count(*))) + 1.0 AS idf "
            "FROM tf WHERE doc_id IN (SELECT doc_id FROM fitted) GROUP BY term",
        ),
        (
            "raw",
            "SELECT tf.doc_id, tf.term, tf.tf * v.idf AS x FROM tf JOIN vocab v ON tf.term = v.term",
        ),
        ("norms", "SELECT doc_id, sqrt(sum(x * x)) AS norm FROM raw GROUP BY doc_id"),
        (
            "w",
            "SELECT raw.doc_id, docs.label, raw.term, raw.x / norms.norm AS w FROM raw "
            "JOIN norms ON raw.doc_id = norms.doc_id JOIN docs ON raw.doc_id = docs.doc_id",
        ),
    ]


_INDEX = ("indexed", "SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, df FROM vocab")


def _vector_digest(keys: str, position: str, columns: str) -> str:
    """A vector's size, positions and two sums over its values, from its entries one by one."""
    return (
        f"SELECT {keys}, CAST(any_value({columns}) AS INTEGER) AS n_columns, "
        "CAST(count(w.w) AS INTEGER) AS n_entries, "
        f"md5(coalesce(string_agg(CAST({position} AS VARCHAR), ',' ORDER BY idx), '')) AS positions, "
        "round(coalesce(sum(w.w * w.w), 0), 6) AS squares, "
        f"round(coalesce(sum(w.w * ({position} % 97 + 1)), 0), 6) AS placed "
        "FROM docs LEFT JOIN w ON docs.doc_id = w.doc_id LEFT JOIN indexed ON w.term = indexed.term "
        "GROUP BY ALL"
    )


# --- Naive Bayes --------------------------------------------------------------------------------


def _bayes_ctes(ctes: Ctes, train: str = "label IS NOT NULL") -> Ctes:
    return [
        *ctes,
        ("members", f"SELECT doc_id, label FROM docs WHERE {train}"),
        (
            "ns",
            "SELECT count(*) AS n, count(*) FILTER (label = 0) AS n0, "
            "count(*) FILTER (label = 1) AS n1 FROM members",
        ),
        (
            "s",
            "SELECT v.term, coalesce(sum(x.w) FILTER (x.label = 0), 0) AS s0, "
            "coalesce(sum(x.w) FILTER (x.label = 1), 0) AS s1 FROM vocab v LEFT JOIN "
            "(SELECT * FROM w WHERE doc_id IN (SELECT doc_id FROM members)) x "
            "ON v.term = x.term GROUP BY v.term",
        ),
        ("totals", "SELECT sum(s0) AS t0, sum(s1) AS t1, count(*) AS v FROM s"),
        (
            "theta",
            "SELECT term, ln(s0 + 1) - ln(t0 + v) AS theta0, ln(s1 + 1) - ln(t1 + v) AS theta1 "
            "FROM s, totals",
        ),
        ("pi", "SELECT ln(n0 + 1) - ln(n + 2) AS pi0, ln(n1 + 1) - ln(n + 2) AS pi1 FROM ns"),
        (
            "scores",
            "SELECT docs.doc_id, docs.label, pi0 + coalesce(sum(w.w * theta0), 0) AS score0, "
            "pi1 + coalesce(sum(w.w * theta1), 0) AS score1 FROM docs CROSS JOIN pi "
            "LEFT JOIN w ON docs.doc_id = w.doc_id LEFT JOIN theta ON w.term = theta.term "
            "GROUP BY docs.doc_id, docs.label, pi0, pi1",
        ),
        (
            "predicted",
            "SELECT *, CASE WHEN score1 > score0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
            "AS prediction FROM scores",
        ),
    ]


_NAMED = (
    "SELECT CAST(doc_id AS VARCHAR) AS name, prediction, round(score0, 6) AS score0, "
    "round(score1, 6) AS score1 FROM predicted WHERE label IS NULL"
)


def _accuracy(where: str) -> str:
    return (
        "SELECT count(*) AS n_test, CAST(sum(CAST(prediction = label AS INTEGER)) AS BIGINT) "
        "AS n_correct, round(avg(CAST(prediction = label AS INTEGER)), 6) AS accuracy "
        f"FROM predicted WHERE {where}"
    )


def _nb_accuracy(analyze: str = "unigram", fit: str = "label IS NOT NULL") -> str:
    return _sql(_bayes_ctes(_weight_ctes(_LABELED, analyze, fit), _TRAIN), _accuracy(f"NOT {_TRAIN}"))


# --- gradient descent ---------------------------------------------------------------------------

_RESIDUALS = {
    "hinge": "CASE WHEN margin * (2 * label - 1) < 1 THEN -(2 * label - 1) ELSE 0 END",
    "logistic": "1 / (1 + exp(-margin)) - label",
}


def _descent_ctes(ctes: Ctes, loss: str, steps: int, train: str = "label IS NOT NULL") -> Ctes:
    ctes = [
        *ctes,
        ("members", f"SELECT doc_id, label FROM docs WHERE {train}"),
        ("x", "SELECT w.* FROM w WHERE doc_id IN (SELECT doc_id FROM members)"),
        ("n", "SELECT count(*) AS n FROM members"),
        ("coef0", "SELECT DISTINCT term, 0.0::DOUBLE AS coef FROM x"),
    ]
    for k in range(1, steps + 1):
        ctes += [
            (
                f"margin{k}",
                "SELECT doc_id, label, sum(x.w * c.coef) AS margin FROM x "
                f"JOIN coef{k - 1} c ON x.term = c.term GROUP BY doc_id, label",
            ),
            (f"res{k}", f"SELECT doc_id, {_RESIDUALS[loss]} AS r FROM margin{k}"),
            (
                f"grad{k}",
                "SELECT term, sum(x.w * r) / (SELECT n FROM n) AS g FROM x "
                f"JOIN res{k} ON x.doc_id = res{k}.doc_id GROUP BY term",
            ),
            (
                f"coef{k}",
                f"SELECT c.term, c.coef * (1 - 0.01 / sqrt({k})) - g / sqrt({k}) AS coef "
                f"FROM coef{k - 1} c JOIN grad{k} ON c.term = grad{k}.term",
            ),
        ]
    return ctes


def _margin_ctes(ctes: Ctes, coefficients: str) -> Ctes:
    return [
        *ctes,
        (
            "predicted",
            "SELECT *, CAST(margin > 0 AS INTEGER) AS prediction FROM ("
            "SELECT docs.doc_id, docs.label, coalesce(sum(w.w * c.coef), 0) AS margin FROM docs "
            "LEFT JOIN w ON docs.doc_id = w.doc_id "
            f"LEFT JOIN {coefficients} c ON w.term = c.term GROUP BY docs.doc_id, docs.label)",
        ),
    ]


def _coefficients(loss: str, steps: int, train: str = "label IS NOT NULL") -> str:
    ctes = _descent_ctes(_weight_ctes(), loss, steps, train)
    return _sql(ctes, f"SELECT term, round(coef, 9) AS coef FROM coef{steps}")


def _long_descent(
    loss: str,
    select: str = "SELECT term, round(coef, 9) AS coef FROM coefs",
    source: str = _LABELED,
    train: str = "label IS NOT NULL",
    steps: int = 100,
) -> str:
    """All steps in one recursive table, with the rule that ends the descent early."""
    margins = (
        "SELECT x.doc_id, x.label, any_value(it.k) AS k, sum(x.w * it.coef) AS margin FROM x "
        "JOIN it ON x.term = it.term GROUP BY x.doc_id, x.label"
    )
    gradient = (
        f"SELECT x.term, sum(x.w * r.r) / (SELECT n FROM n) AS g FROM x JOIN "
        f"(SELECT doc_id, {_RESIDUALS[loss]} AS r FROM ({margins})) r ON x.doc_id = r.doc_id "
        "GROUP BY x.term"
    )
    update = (
        "SELECT it.k + 1 AS k, it.term, it.coef AS old, "
        "it.coef * (1 - 0.01 / sqrt(it.k + 1)) - g.g / sqrt(it.k + 1) AS coef "
        f"FROM it JOIN ({gradient}) g ON it.term = g.term WHERE it.k < {steps} AND NOT it.done"
    )
    step = (
        "SELECT k, term, coef, k > 1 AND sqrt(sum((coef - old) * (coef - old)) OVER ()) < "
        f"0.001 * greatest(sqrt(sum(coef * coef) OVER ()), 1) AS done FROM ({update})"
    )
    ctes = _descent_ctes(_weight_ctes(source), loss, 0, train)
    body = ",\n".join(f"{name} AS MATERIALIZED ({query})" for name, query in ctes)
    last = [("coefs", "SELECT term, coef FROM it WHERE k = (SELECT max(k) FROM it)")]
    after = ",\n".join(f"{name} AS ({query})" for name, query in _margin_ctes(last, "coefs"))
    return (
        f"WITH RECURSIVE {body},\nit(k, term, coef, done) AS ("
        f"SELECT 0, term, coef, false FROM coef0 UNION ALL {step}),\n{after}\n{select}"
    )


# --- trees --------------------------------------------------------------------------------------

_HEX28 = "CAST('0x' || substr(md5({0}), {1}, 7) AS BIGINT)"
_BINNED = (
    "b",
    "SELECT doc_id, term, 31 - least(30, greatest(0, CAST(floor(-4 * log2(w) + 0.137) AS INTEGER))) "
    f"AS bin, {_HEX28.format('term', 1)} AS h FROM w",
)
# Gain of sending (n, s) of a node's (all_n, all_s) to the right.
_GAIN = (
    "CAST(floor(((all_s - s) / {0} * ((all_s - s) / {0}) / (all_n - n) + s / {0} * (s / {0}) / n "
    "- all_s / {0} * (all_s / {0}) / all_n) * 1e6) AS BIGINT)"
)


def _best_split(hist: str, totals: str, keys: str, scale: str) -> str:
    """Best (term, bin) for each node: running sums from the highest bin, compared in whole steps."""
    window = f"OVER (PARTITION BY {keys}, term ORDER BY bin DESC)"
    on = " AND ".join(f"r.{k} = t.{k}" for k in keys.split(", "))
    nodes = ", ".join(f"r.{k}" for k in keys.split(", "))
    return (
        f"SELECT {keys}, term, bin, n, s FROM (SELECT *, {_GAIN.format(scale)} AS gain FROM ("
        f"SELECT {nodes}, term, bin, r.n, r.s, t.n AS all_n, t.s AS all_s FROM (SELECT {keys}, term, bin, "
        f"CAST(sum(n) {window} AS BIGINT) AS n, CAST(sum(s) {window} AS BIGINT) AS s FROM {hist}) r "
        f"JOIN {totals} t ON {on}) WHERE n > 0 AND all_n > n) WHERE gain > 0 "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY gain DESC, term, bin) = 1"
    )


def _forest_ctes(train: str, trees: int = 3, source: str = _LABELED, depth: int = 4) -> Ctes:
    """Trees level by level; every document walks along, those of the sample are counted."""
    bounds, total, share = [], 0.0, math.exp(-1)
    for k in range(8):
        total += share
        bounds.append(math.floor(total * 2**32))
        share /= k + 1
    u = "CAST('0x' || substr(md5('2:' || tree || ':' || doc_id), 1, 8) AS BIGINT)"
    copies = " + ".join(f"CAST({u} >= {bound} AS INTEGER)" for bound in bounds)
    ctes = [
        *_weight_ctes(source),
        _BINNED,
        ("draw", "SELECT CAST(floor(2147483647::HUGEINT * ceil(sqrt(count(*))) / count(*)) AS BIGINT) AS below FROM vocab"),
        (
            "place0",
            f"SELECT tree, doc_id, label, 0 AS node, CASE WHEN {train} THEN {copies} ELSE 0 END AS n "
            f"FROM docs, (SELECT range AS tree FROM range({trees}))",
        ),
    ]
    for k in range(depth):
        ctes += [
            (
                f"totals{k}",
                "SELECT tree, node, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * label) AS BIGINT) AS s, "
                f"1 + {_HEX28.format("'2:' || tree || ':' || node", 1)} AS a, "
                f"{_HEX28.format("'2:' || tree || ':' || node", 8)} AS c FROM place{k} GROUP BY tree, node",
            ),
            (
                f"hist{k}",
                "SELECT p.tree, p.node, term, bin, sum(p.n) AS n, CAST(sum(p.n * label) AS BIGINT) AS s "
                f"FROM place{k} p JOIN totals{k} t ON p.tree = t.tree AND p.node = t.node "
                "JOIN b ON p.doc_id = b.doc_id, draw WHERE p.n > 0 AND (a * h + c) % 2147483647 < below "
                "GROUP BY p.tree, p.node, term, bin",
            ),
            (f"best{k}", _best_split(f"hist{k}", f"totals{k}", "tree, node", "1.0")),
            (
                f"place{k + 1}",
                "SELECT p.tree, p.doc_id, p.label, CASE WHEN x.term IS NULL THEN p.node ELSE "
                "2 * p.node + 1 + CAST(coalesce(b.bin, 0) >= x.bin AS INTEGER) END AS node, p.n "
                f"FROM place{k} p LEFT JOIN best{k} x ON p.tree = x.tree AND p.node = x.node "
                "LEFT JOIN b ON p.doc_id = b.doc_id AND x.term = b.term",
            ),
        ]
    return [
        *ctes,
        (
            "leaves",
            "SELECT tree, node, 2 * sum(n * label) > sum(n) AS one "
            f"FROM place{depth} GROUP BY tree, node",
        ),
        (
            "predicted",
            "SELECT *, CAST(score > " + f"{trees / 2}" + " AS INTEGER) AS prediction FROM ("
            "SELECT p.doc_id, p.label, CAST(count(*) FILTER (one) AS DOUBLE) AS score "
            f"FROM place{depth} p JOIN leaves l ON p.tree = l.tree AND p.node = l.node "
            "GROUP BY p.doc_id, p.label)",
        ),
    ]


def _forest_nodes(train: str) -> str:
    """Nodes of all levels with their totals, and the split of those that have one."""
    levels = [f"SELECT tree, node, n, s, {k} AS k FROM totals{k}" for k in range(4)]
    last = (
        "SELECT tree, node, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * label) AS BIGINT) AS s, 4 AS k "
        "FROM place4 GROUP BY tree, node"
    )
    splits = " UNION ALL ".join(f"SELECT tree, node, term, bin FROM best{k}" for k in range(4))
    ctes = [
        *_forest_ctes(train),
        ("all_nodes", " UNION ALL ".join([*levels, last])),
        ("splits", splits),
    ]
    return _sql(
        ctes,
        "SELECT CAST(x.tree AS INTEGER) AS tree, CAST(x.node AS INTEGER) AS node, term, "
        "CAST(bin AS INTEGER) AS bin, x.n, x.s FROM (SELECT DISTINCT tree, node, n, s FROM all_nodes) x "
        "LEFT JOIN splits ON x.tree = splits.tree AND x.node = splits.node",
    )


def _boosted(select: str, train: str, source: str = _LABELED, rounds: int = 30, depth: int = 4) -> str:
    """A recursive table of documents: a step divides the nodes of a level, or ends a round.

    ``log`` rows of a finished tree are not kept; ``margin`` is the sum of the leaves so far.
    """
    steps = depth + 1
    units = (
        f"CAST(floor(CASE WHEN k < {steps} THEN 2 * label - 1 ELSE 4 * (2 * label - 1) / "
        "(1 + exp(2 * (2 * label - 1) * margin)) END * 1000000 + 0.5) AS BIGINT)"
    )
    rate = f"CASE WHEN k < {steps} THEN 1.0::DOUBLE ELSE 0.1::DOUBLE END"
    step = (
        f"WITH r AS (SELECT *, CASE WHEN train THEN {units} END AS s FROM it WHERE k < {rounds * steps}), "
        "totals AS (SELECT node, count(*) AS n, CAST(sum(s) AS BIGINT) AS s FROM r WHERE train GROUP BY node), "
        "hist AS (SELECT node, term, bin, count(*) AS n, sum(s) AS s FROM r JOIN b ON r.doc_id = b.doc_id "
        f"WHERE train AND k % {steps} < {depth} GROUP BY node, term, bin), "
        f"best AS ({_best_split('hist', 'totals', 'node', '1000000.0')}) "
        "SELECT k + 1, r.doc_id, label, train, "
        f"CASE WHEN k % {steps} = {depth} THEN margin + {rate} * (t.s / 1000000.0::DOUBLE / t.n) ELSE margin END, "
        f"CASE WHEN k % {steps} = {depth} THEN 0 WHEN x.term IS NULL THEN r.node "
        "ELSE 2 * r.node + 1 + CAST(coalesce(b.bin, 0) >= x.bin AS INTEGER) END "
        "FROM r JOIN totals t ON r.node = t.node LEFT JOIN best x ON r.node = x.node "
        "LEFT JOIN b ON r.doc_id = b.doc_id AND x.term = b.term"
    )
    body = ",\n".join(
        f"{name} AS MATERIALIZED ({query})" for name, query in [*_weight_ctes(source), _BINNED]
    )
    return (
        f"WITH RECURSIVE {body},\nit(k, doc_id, label, train, margin, node) AS ("
        f"SELECT 0, doc_id, label, {train}, 0.0::DOUBLE, 0 FROM docs UNION ALL ({step})),\n"
        "predicted AS (SELECT *, margin AS score, CAST(margin > 0 AS INTEGER) AS prediction FROM it "
        f"WHERE k = {rounds * steps})\n{select}"
    )


_SCORED = "SELECT doc_id, label, round(score, 6) AS score, prediction FROM predicted"
_SCORED_UNLABELED = (
    "SELECT doc_id, round(score, 6) AS score, prediction FROM predicted WHERE label IS NULL"
)

# --- committee ----------------------------------------------------------------------------------


def _committee_ctes(rounds: int, source: str = _LABELED) -> Ctes:
    models = "SELECT DISTINCT bucket AS model_id FROM bucketed WHERE bucket < 40"
    uses = "SELECT model_id, model_id AS bucket FROM models"
    if rounds == 2:
        uses += " UNION ALL SELECT model_id, (model_id + 1) % 40 AS bucket FROM models"
    parameter = [
        f"s{c} / nullif(n{c}, 0) AS mu{c}, "
        f"greatest(ss{c} / nullif(n{c}, 0) - (s{c} / nullif(n{c}, 0)) * (s{c} / nullif(n{c}, 0)), 0) "
        f"+ eps AS var{c}"
        for c in (0, 1)
    ]
    base = [
        f"CASE WHEN n{c} > 0 THEN ln(n{c} / CAST(n0 + n1 AS DOUBLE)) - 0.5 * "
        f"(coalesce(sum(ln(2 * pi() * var{c}) + mu{c} * mu{c} / var{c}), 0) + "
        f"((SELECT count(*) FROM vocab) - count(p.term)) * ln(2 * pi() * e.eps)) END AS base{c}"
        for c in (0, 1)
    ]
    return [
        *_weight_ctes(source),
        (
            "bucketed",
            f"SELECT doc_id, label, CAST({_bucket('doc_id', 50)} AS INTEGER) AS bucket FROM docs "
            "WHERE label IS NOT NULL",
        ),
        ("models", models),
        ("uses", uses),
        (
            "counts",
            "SELECT model_id, count(*) FILTER (label = 0) AS n0, "
            "count(*) FILTER (label = 1) AS n1 FROM uses JOIN bucketed "
            "ON uses.bucket = bucketed.bucket GROUP BY model_id",
        ),
        (
            "stats",
            "SELECT model_id, term, coalesce(sum(w) FILTER (w.label = 0), 0) AS s0, "
            "coalesce(sum(w * w) FILTER (w.label = 0), 0) AS ss0, "
            "coalesce(sum(w) FILTER (w.label = 1), 0) AS s1, "
            "coalesce(sum(w * w) FILTER (w.label = 1), 0) AS ss1 FROM uses "
            "JOIN bucketed ON uses.bucket = bucketed.bucket "
            "JOIN w ON bucketed.doc_id = w.doc_id GROUP BY model_id, term",
        ),
        (
            "widest",
            "SELECT counts.model_id, max((ss0 + ss1) / (n0 + n1) - "
            "((s0 + s1) / (n0 + n1)) * ((s0 + s1) / (n0 + n1))) AS v "
            "FROM counts LEFT JOIN stats ON counts.model_id = stats.model_id "
            "GROUP BY counts.model_id",
        ),
        (
            "epsilons",
            "SELECT model_id, CASE WHEN v > 1e-12 THEN 1e-9 * v ELSE 1e-9 END AS eps FROM widest",
        ),
        (
            "params",
            f"SELECT stats.model_id, term, {', '.join(parameter)} FROM stats "
            "JOIN counts ON stats.model_id = counts.model_id "
            "JOIN epsilons ON stats.model_id = epsilons.model_id",
        ),
        (
            "bases",
            f"SELECT counts.model_id, e.eps, {', '.join(base)} FROM counts "
            "JOIN epsilons e ON counts.model_id = e.model_id "
            "LEFT JOIN params p ON counts.model_id = p.model_id "
            "GROUP BY counts.model_id, e.eps, n0, n1",
        ),
    ]


def _vote_ctes(where: str, source: str = _LABELED, voted: str = "bucketed") -> Ctes:
    gains = [
        f"coalesce(sum(CASE WHEN p.term IS NULL THEN -w.w * w.w / (2 * b.eps) "
        f"ELSE w.w * (p.mu{c} - w.w / 2) / p.var{c} END), 0) AS gain{c}"
        for c in (0, 1)
    ]
    softmax = [
        f"CASE WHEN base{a} IS NULL THEN 0 WHEN base{b} IS NULL THEN 1 "
        f"ELSE 1 / (1 + exp(least((base{b} + gain{b}) - (base{a} + gain{a}), 700))) END AS p{a}"
        for a, b in ((0, 1), (1, 0))
    ]
    return [
        *_committee_ctes(2, source),
        (
            "gains",
            f"SELECT d.doc_id, d.label, b.model_id, b.base0, b.base1, {', '.join(gains)} "
            f"FROM (SELECT * FROM {voted} WHERE {where}) d CROSS JOIN bases b "
            "LEFT JOIN w ON d.doc_id = w.doc_id "
            "LEFT JOIN params p ON p.model_id = b.model_id AND p.term = w.term "
            "GROUP BY d.doc_id, d.label, b.model_id, b.base0, b.base1",
        ),
        (
            "chances",
            f"SELECT doc_id, label, model_id, {', '.join(softmax)}, "
            "CASE WHEN base0 IS NULL THEN 1 WHEN base1 IS NULL THEN 0 "
            "WHEN base1 + gain1 > base0 + gain0 THEN 1 ELSE 0 END AS choice FROM gains",
        ),
    ]


_SOFT = (
    "predicted",
    "SELECT *, CASE WHEN votes0 >= votes1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prediction "
    "FROM (SELECT doc_id, label, sum(p0) AS votes0, sum(p1) AS votes1 FROM chances "
    "GROUP BY doc_id, label)",
)
_HARD = (
    "predicted",
    "SELECT *, CASE WHEN votes0 >= votes1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prediction "
    "FROM (SELECT doc_id, label, count(*) FILTER (choice = 0) AS votes0, "
    "count(*) FILTER (choice = 1) AS votes1 FROM chances GROUP BY doc_id, label)",
)


def _sample(k: int) -> str:
    return (
        "SELECT name, label, md5(text) AS digest FROM (SELECT doc_id, "
        "CAST(doc_id AS VARCHAR) AS name, CAST(quality AS DOUBLE) AS label, row_number() OVER "
        "(PARTITION BY quality ORDER BY CAST(doc_id AS VARCHAR)) AS r FROM labels) x "
        f"JOIN documents d ON x.doc_id = d.doc_id WHERE r <= {k}"
    )


def _strip_steps() -> str:
    digests = ", ".join(
        f"md5(regexp_replace(html, '{pattern}', ' ', 'g')) AS {name}" for name, pattern in _STEPS
    )
    return f"SELECT page_id AS doc_id, {digests} FROM pages"


_TRIPLE_ROWS = (
    "SELECT w.doc_id, CAST(count(*) AS INTEGER) AS n_cells, "
    "string_agg(idx || ':' || CAST(round(w.w * 1e6) AS BIGINT), ' ' ORDER BY idx) AS row "
    "FROM w JOIN indexed ON w.term = indexed.term GROUP BY w.doc_id"
)
_WEIGHTS = "SELECT doc_id, term, round(w, 6) AS w FROM w"
_HELD_OUT = "bucket >= 40"

ORACLES: dict[str, str] = {
    "strip_steps": _strip_steps(),
    "clean_documents": f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents",
    "clean_pages": f"SELECT page_id AS doc_id, {_clean('html')} AS cleaned FROM pages",
    "decode_text": "SELECT doc_id, md5(text) AS digest FROM documents",
    "sentences": _sql(
        _token_ctes(_EVERY)[:4],
        "SELECT docs.doc_id, CAST(count(s) AS INTEGER) AS n_sentences, "
        "coalesce(string_agg(s, '|' ORDER BY spos), '') AS sentences FROM docs LEFT JOIN "
        "(SELECT * FROM sents WHERE trim(s) <> '') x ON docs.doc_id = x.doc_id "
        "GROUP BY docs.doc_id",
    ),
    "tokens": _sql(_token_ctes(_EVERY), _listed("toks", "t", "n_tokens", "tokens")),
    "stopword_filtered": _sql(_token_ctes(_EVERY), _listed("kept", "t", "n_tokens", "tokens")),
    "stem_vocabulary": _sql(
        _token_ctes(_EVERY) + _stem_ctes(), "SELECT t AS token, stem FROM stems"
    ),
    "terms_unigram": _sql(_term_ctes(_EVERY), _listed("terms", "term", "n_terms", "terms")),
    "terms_bigram": _sql(
        _term_ctes(_EVERY, "bigram"), _listed("terms", "term", "n_terms", "terms")
    ),
    "terms_alt": _sql(
        _term_ctes(_EVERY, "plain"), _listed("terms", "term", "n_terms", "terms")
    ),
    "collocations_top300": _collocations(),
    "sample_k_per_class": _sample(1000),
    "sample_100_per_class": _sample(100),
    "union_classes": "SELECT d.doc_id, CAST(quality AS DOUBLE) AS label, md5(text) AS digest "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IN (0, 1)",
    "random_split": "SELECT count(*) AS n_rows, 0::BIGINT AS n_both, 0::BIGINT AS n_neither "
    "FROM labels",
    "label_join": "SELECT d.doc_id, CAST(quality AS DOUBLE) AS label, "
    "CAST(length(text) AS INTEGER) AS n_chars FROM documents d JOIN labels l "
    "ON d.doc_id = l.doc_id",
    "name_join": "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, "
    "CAST(doc_id AS VARCHAR) AS name FROM documents",
    "bucket_split": f"SELECT doc_id, CAST({_bucket('doc_id', 50)} AS INTEGER) AS bucket, "
    f"{_bucket('doc_id', 50)} < 40 AS in_committee, {_TRAIN} AS in_train FROM documents",
    "corpus_roundtrip": "SELECT d.doc_id, CAST(quality AS DOUBLE) AS label, md5(text) AS digest "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "unlabeled_folder": "SELECT doc_id, octet_length(encode(doc_id || chr(10) || text)) + 1 AS length, "
    "md5(text) AS digest FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    # Each byte that can't go on a sequence is replaced: 1, 1, 2, 3 and 1 replacements.
    "decoded_folder": "SELECT doc_id, doc_id % 2 = 1 AS malformed, md5(CASE WHEN doc_id % 2 = 1 THEN "
    "repeat(chr(65533), [1, 1, 2, 3, 1][doc_id % 5 + 1]) ELSE '' END || text) AS digest FROM documents",
    "term_frequency": _sql(_weight_ctes(), "SELECT doc_id, term, tf FROM tf"),
    "document_frequency": _sql(_weight_ctes(), "SELECT term, df FROM vocab"),
    "vocabulary": _sql([*_weight_ctes(), _INDEX], "SELECT term, idx, df FROM indexed"),
    "idf": _sql(_weight_ctes(), "SELECT term, round(idf, 6) AS idf FROM vocab"),
    "tfidf_l2": _sql(_weight_ctes(), _WEIGHTS),
    "tfidf_transform_unlabeled": _sql(_weight_ctes(_EVERY), _WEIGHTS + " WHERE label IS NULL"),
    "tfidf_alternate": _sql(_weight_ctes(_LABELED, "plain"), _WEIGHTS),
    "feature_count": _sql(_weight_ctes(), "SELECT count(*) AS n_features FROM vocab"),
    "dense_size_estimate": _sql(
        _weight_ctes(),
        "SELECT n_rows, n_columns, CAST(floor(n_rows * n_columns * 8 / 1073741824.0) AS BIGINT) "
        "AS size_gb FROM (SELECT (SELECT count(*) FROM docs) AS n_rows, "
        "(SELECT count(*) FROM vocab) AS n_columns)",
    ),
    "rows_from_triples": _sql([*_weight_ctes(), _INDEX], _TRIPLE_ROWS),
    "vector_pipeline": _sql(
        [*_bayes_ctes(_weight_ctes()), _INDEX],
        "SELECT p.doc_id, p.label, p.prediction, v.* EXCLUDE (doc_id) FROM predicted p JOIN "
        f"({_vector_digest('docs.doc_id', 'idx', '(SELECT count(*) FROM indexed)')}) v "
        "ON p.doc_id = v.doc_id",
    ),
    "vector_blocks": _sql(
        [*_weight_ctes(), _INDEX],
        _vector_digest(
            "docs.doc_id, coalesce(idx // 1000, 0) AS block",
            "idx % 1000",
            "least(1000, (SELECT count(*) FROM indexed) - coalesce(idx // 1000, 0) * 1000)",
        ),
    ),
    "vocabulary_update": _sql(_weight_ctes(), "SELECT term, df, round(idf, 6) AS idf FROM vocab"),
    "tfidf_transform_stored": _sql(
        _weight_ctes(_EVERY), _WEIGHTS + " WHERE label IS NULL"
    ),
    "nb_train": _sql(
        _bayes_ctes(_weight_ctes()),
        "SELECT term, round(theta0, 6) AS theta0, round(theta1, 6) AS theta1, "
        "round(pi0, 6) AS pi0, round(pi1, 6) AS pi1 FROM theta, pi",
    ),
    "nb_predict_unlabeled": _sql(_bayes_ctes(_weight_ctes(_EVERY)), _NAMED),
    "nb_predict_bigrams": _sql(_bayes_ctes(_weight_ctes(_EVERY, "bigram")), _NAMED),
    "nb_holdout_accuracy": _nb_accuracy(),
    "nb_holdout_accuracy_train_fit": _nb_accuracy(fit=_TRAIN),
    "nb_holdout_accuracy_bigrams": _nb_accuracy("bigram"),
    "svm_one_step": _coefficients("hinge", 1, _TRAIN),
    "svm_one_step_accuracy": _sql(
        _margin_ctes(_descent_ctes(_weight_ctes(), "hinge", 1, _TRAIN), "coef1"),
        _accuracy(f"NOT {_TRAIN}"),
    ),
    **{
        f"{name}_holdout_accuracy": _long_descent(
            loss, _accuracy(f"NOT {_TRAIN}"), train=_TRAIN
        )
        for name, loss in (("svm", "hinge"), ("logreg", "logistic"))
    },
    "svm_gd3": _coefficients("hinge", 3),
    "logreg_gd3": _coefficients("logistic", 3),
    **{
        f"{name}_predict_unlabeled": _long_descent(
            loss,
            "SELECT doc_id, round(margin, 6) AS margin, prediction FROM predicted "
            "WHERE label IS NULL",
            source=_EVERY,
        )
        for name, loss in (("svm", "hinge"), ("logreg", "logistic"))
    },
    "svm_gd100": _long_descent("hinge"),
    "logreg_gd100": _long_descent("logistic"),
    "random_forest": _sql(_forest_ctes(_TRAIN), f"{_SCORED} WHERE NOT {_TRAIN}"),
    "forest_nodes": _forest_nodes(_TRAIN),
    "forest_accuracy": _sql(_forest_ctes(_TRAIN), _accuracy(f"NOT {_TRAIN}")),
    "forest_300_accuracy": _sql(_forest_ctes(_TRAIN, 300), _accuracy(f"NOT {_TRAIN}")),
    "forest_predict_unlabeled": _sql(
        _forest_ctes("label IS NOT NULL", source=_EVERY), _SCORED_UNLABELED
    ),
    "gbt": _boosted(f"{_SCORED} WHERE NOT train", _TRAIN),
    "gbt_accuracy": _boosted(_accuracy("NOT train"), _TRAIN),
    "gbt_predict_unlabeled": _boosted(_SCORED_UNLABELED, "label IS NOT NULL", _EVERY),
    "prediction_sink": _sql(
        _bayes_ctes(_weight_ctes(_EVERY)),
        "SELECT doc_id || ',' || CASE WHEN prediction = 1 THEN '1.0' ELSE '0.0' END AS line "
        "FROM predicted WHERE label IS NULL",
    ),
    "gnb_bucket_stats": _sql(
        _committee_ctes(1),
        "SELECT model_id, term, round(s0, 6) AS s0, round(ss0, 6) AS ss0, round(s1, 6) AS s1, "
        "round(ss1, 6) AS ss1 FROM stats",
    ),
    "gnb_second_round": _sql(
        _committee_ctes(2),
        "SELECT model_id, term, round(mu0, 9) AS mu0, round(var0, 9) AS var0, "
        "round(mu1, 9) AS mu1, round(var1, 9) AS var1 FROM params",
    ),
    "committee_update": _sql(
        _committee_ctes(2),
        "SELECT model_id, term, round(mu0, 9) AS mu0, round(var0, 9) AS var0, "
        "round(mu1, 9) AS mu1, round(var1, 9) AS var1 FROM params",
    ),
    "soft_vote": _sql(
        [*_vote_ctes(_HELD_OUT), _SOFT],
        "SELECT doc_id, label, round(votes0, 3) AS votes0, round(votes1, 3) AS votes1, "
        "prediction FROM predicted",
    ),
    "hard_vote": _sql(
        [*_vote_ctes(_HELD_OUT), _HARD],
        "SELECT doc_id, label, votes0, votes1, prediction FROM predicted",
    ),
    "committee_predict_unlabeled": _sql(
        [*_vote_ctes("label IS NULL", _EVERY, "docs"), _HARD],
        "SELECT doc_id, votes0, votes1, prediction FROM predicted",
    ),
    "voted_accuracy": _sql([*_vote_ctes(_HELD_OUT), _SOFT], _accuracy("true")),
    "resubstitution_accuracy": _sql([*_vote_ctes("true"), _HARD], _accuracy("true")),
}
