"""DuckDB SQL spellings of the cleaning steps, used only by the correctness oracles.

Each helper mirrors one ``moodlens.functions`` column function and takes/returns a SQL
expression string.  Regexes are the very same strings the Spark side uses.
"""

from __future__ import annotations

from ..functions import entities as EN
from ..functions import text as T
from ..functions.fixed import COMMON_HTML_ENTITIES, CONTRACTION_RULES
from ..functions.lexicon import dict_order, fold_pairs, hitting_class
from ..sources.tweets import DECORATIONS, TWEET_DATE


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rr(expr: str, pattern: str, repl: str) -> str:
    repl = repl.replace("$1", "\\1")
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, 'g')"


def tweets_cte(decorate: bool = True) -> str:
    deco = "CASE d.doc_id % {n} {whens} ELSE '' END".format(
        n=len(DECORATIONS),
        whens=" ".join(f"WHEN {i} THEN {q(t)}" for i, t in enumerate(DECORATIONS)),
    )
    text = f"(d.text || {deco})" if decorate else "d.text"
    return f"""tweets AS (
  SELECT CAST(CASE WHEN l.quality = 1 THEN 4 WHEN l.toxic = 1 THEN 0
                   WHEN l.quality IS NOT NULL THEN 2 END AS INTEGER) AS Polarity,
         d.doc_id AS TweetID, {q(TWEET_DATE)} AS "Date", 'NO_QUERY' AS QueryFlag, d.source AS "User",
         {text} AS TweetText
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def strip_ws(e: str) -> str:
    return rr(e, f"^{T.WS}+|{T.WS}+$", "")


def replace_url(e: str) -> str:
    return strip_hashtag(rr(e, T.URL_RE, "URL"))


def replace_url_padded(e: str) -> str:
    return rr(e, T.URL_PADDED_RE, " URL ")


def replace_mention(e: str, token: str = "atUser") -> str:
    return rr(e, T.MENTION_RE, token)


def strip_hashtag(e: str) -> str:
    return rr(e, T.HASHTAG_RE, "$1")


def collapse_repeats(e: str) -> str:
    e = rr(e, r"!{2,}", " multiExclamation ")
    e = rr(e, r"\?{2,}", " multiQuestion ")
    return rr(e, r"\.{2,}", " multiStop ")


def remove_unicode(e: str) -> str:
    return rr(rr(e, T.ESCAPED_UNICODE_RE, ""), T.NON_ASCII_RE, "")


def expand_contractions(e: str) -> str:
    for p, r in CONTRACTION_RULES:
        e = rr(e, p, r)
    return e


def keep_alnum(e: str) -> str:
    return rr(e, T.NON_ALNUM_RE, " ")


def replace_literals(e: str, pairs, pad: bool = False) -> str:
    for k, v in pairs:
        e = f"replace({e}, {q(k)}, {q(f' {v} ' if pad else v)})"
    return e


def html_unescape_common(e: str) -> str:
    return replace_literals(e, COMMON_HTML_ENTITIES)


def html_unescape_full(e: str) -> str:
    """Character references by the rules of ``functions.entities``, in DuckDB's functions."""
    closed, old, windows = (
        "MAP {" + ", ".join(f"{q(k) if isinstance(k, str) else k}: {q(v)}" for k, v in sorted(m.items())) + "}" for m in (EN.CLOSED, EN.OPEN, EN.WINDOWS)
    )

    def number(pattern, prefix):
        return f"TRY_CAST({prefix} || ('0' || ltrim(regexp_extract(p, {q(pattern)}, 1), '0')) AS BIGINT)"

    def character(n):
        gone = f"{n} BETWEEN 1 AND 8 OR {n} = 11 OR {n} BETWEEN 14 AND 31 OR {n} = 127 OR {n} BETWEEN 64976 AND 65007 OR ({n} & 65534) = 65534"
        return (
            f"CASE WHEN {n} IS NULL OR {n} = 0 OR {n} BETWEEN 55296 AND 57343 OR {n} > 1114111 THEN chr(65533) "
            f"WHEN {n} BETWEEN 128 AND 159 THEN {windows}[CAST({n} AS INTEGER)] WHEN {gone} THEN '' ELSE chr(CAST({n} AS INTEGER)) END"
        )

    dec, hexa = number(EN.DECIMAL_RE, "''"), number(EN.HEX_RE, "'0x'")
    name, prefix = f"regexp_extract(p, {q(EN.NAME_RE)}, 1)", f"regexp_extract(p, {q(EN.OPEN_RE)}, 1)"
    one = (
        f"CASE WHEN regexp_matches(p, {q(EN.DECIMAL_RE)}) THEN ({character(dec)}) || regexp_replace(p, {q(EN.DECIMAL_RE)}, '') "
        f"WHEN regexp_matches(p, {q(EN.HEX_RE)}) THEN ({character(hexa)}) || regexp_replace(p, {q(EN.HEX_RE)}, '') "
        f"WHEN {closed}[{name}] IS NOT NULL THEN {closed}[{name}] || substr(p, length({name}) + 2) "
        f"WHEN {prefix} <> '' THEN {old}[{prefix}] || substr(p, length({prefix}) + 1) ELSE '&' || p END"
    )
    return f"list_reduce(string_split({e}, '&'), lambda a, p: a || {one})"


def ordered_replace(e: str, pairs, pad: bool = False, ascii_input: bool = False) -> str:
    return replace_literals(e, fold_pairs(dict_order(pairs), ascii_input=ascii_input), pad=pad)


def split_words(e: str) -> str:
    return f"list_filter(string_split_regex({strip_ws(e)}, {q(T.WS + '+')}), lambda w: w <> '')"


def map_sql(pairs) -> str:
    pairs = dict_order(pairs)
    if not pairs:
        return "MAP {}"
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in pairs) + "}"


def lookup_words(e: str, pairs) -> str:
    m = map_sql(pairs)
    return f"array_to_string(list_transform({split_words(e)}, lambda w: coalesce({m}[w], w)), ' ')"


def lookup_tokens(tokens: str, pairs, resplit: bool = True) -> str:
    pairs = dict_order(pairs)
    if not resplit:
        m = map_sql(pairs)
        return f"list_transform({tokens}, lambda w: coalesce({m}[w], w))"
    if pairs:
        m = "MAP {" + ", ".join(
            f"{q(k)}: [" + ", ".join(q(x) for x in v.split()) + "]::VARCHAR[]" for k, v in pairs
        ) + "}"
    else:
        m = "MAP {}"
    own = f"CASE WHEN regexp_matches(w, {q('^$|' + T.WS)}) THEN {split_words('w')} ELSE [w] END"
    return f"flatten(list_transform({tokens}, lambda w: coalesce({m}[w], {own})))"


def tokenize_regex(e: str) -> str:
    return f"regexp_extract_all({e}, {q(T.TOKEN_RE)})"


def tokenize_ws(e: str) -> str:
    low = f"lower({e})"
    stripped = rr(low, f"{T.JAVA_WS}+$", "")
    return (
        f"CASE WHEN {low} = '' THEN [''] WHEN {stripped} = '' THEN []::VARCHAR[] "
        f"ELSE string_split_regex({stripped}, {q(T.JAVA_WS)}) END"
    )


def remove_stopwords(tokens: str, stopwords, case_sensitive: bool = False) -> str:
    if case_sensitive:
        lst = "[" + ", ".join(q(w) for w in stopwords) + "]"
        return f"list_filter({tokens}, lambda w: NOT list_contains({lst}, w))"
    lst = "[" + ", ".join(q(w.lower()) for w in dict.fromkeys(stopwords)) + "]"
    return f"list_filter({tokens}, lambda w: NOT list_contains({lst}, lower(w)))"


def clean_social_text(e: str, emoticons, abbreviations) -> str:
    t = replace_url(f"lower({e})")
    t = strip_ws(t)
    t = html_unescape_full(t)
    t = remove_unicode(t)
    t = ordered_replace(t, emoticons, ascii_input=True)
    t = lookup_words(t, abbreviations)
    t = replace_mention(t)
    t = strip_hashtag(t)
    t = collapse_repeats(t)
    return expand_contractions(t)


def pos_filter(tokens: str, pos_pairs, default_tag: str = "NN", allowed=("J", "R", "V", "N")) -> str:
    m = map_sql(pos_pairs)
    allowed_sql = ", ".join(q(a) for a in allowed)
    return f"list_filter({tokens}, lambda w: substr(coalesce({m}[w], {q(default_tag)}), 1, 1) IN ({allowed_sql}))"


def clean_social(e: str, emoticons, abbreviations, stopwords, pos_pairs=None) -> str:
    tokens = lookup_tokens(tokenize_regex(clean_social_text(e, emoticons, abbreviations)), abbreviations)
    if pos_pairs is not None:
        tokens = pos_filter(tokens, pos_pairs)
    return f"coalesce({remove_stopwords(tokens, stopwords, case_sensitive=True)}, []::VARCHAR[])"


def classic_words(e: str, abbreviations, emojis, stopwords, lemma_pairs=None, abbrev_mode="substring") -> str:
    t = replace_mention(replace_url_padded(e), " USER ")
    t = ordered_replace(t, emojis, pad=True)
    t = ordered_replace(t, abbreviations, pad=True) if abbrev_mode == "substring" else lookup_words(t, abbreviations)
    t = f"lower({keep_alnum(t)})"
    words = f"list_filter({split_words(t)}, lambda w: length(w) >= 2)"
    words = remove_stopwords(words, stopwords, case_sensitive=True)
    if lemma_pairs is not None:
        words = lookup_tokens(words, lemma_pairs, resplit=False)
    return words


def clean_classic(e: str, *args, **kw) -> str:
    return f"array_to_string(coalesce({classic_words(e, *args, **kw)}, []::VARCHAR[]), ' ')"


def md5_bucket(e: str, buckets: int = 100) -> str:
    return f"CAST(('0x' || substr(md5(CAST({e} AS VARCHAR)), 1, 8))::BIGINT % {buckets} AS INTEGER)"


def classic_job_ctes(abbreviations, emojis, stopwords, max_features: int | None = 500_000, train_pct: int = 90) -> str:
    """CTEs ``corpus, tf, stats, vocab, idf, feat, train_docs, test_docs`` of the classic job."""
    limit = f"LIMIT {max_features}" if max_features is not None else ""
    return f"""WITH {tweets_cte()},
corpus0 AS (
  SELECT TweetID AS doc_id, CAST(CASE WHEN Polarity = 4 THEN 1 ELSE Polarity END AS INTEGER) AS label,
         {clean_classic('TweetText', abbreviations, emojis, stopwords)} AS text
  FROM tweets WHERE Polarity IS NOT NULL),
corpus AS (SELECT doc_id, label, text, string_split(text, ' ') AS words, {md5_bucket('doc_id')} < {train_pct} AS is_train
           FROM corpus0 WHERE length(text) > 0),
grams AS (SELECT doc_id, is_train,
                 unnest(words || CASE WHEN len(words) >= 2
                        THEN list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])
                        ELSE []::VARCHAR[] END) AS term
          FROM corpus),
tf AS (SELECT doc_id, term, is_train, count(*) AS tf FROM grams GROUP BY doc_id, term, is_train),
ndocs AS (SELECT count(DISTINCT doc_id) AS n FROM tf WHERE is_train),
stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf WHERE is_train GROUP BY term),
vocab AS (SELECT * FROM stats ORDER BY cf DESC, term {limit}),
idf AS (SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM vocab, ndocs),
w AS (SELECT tf.doc_id, tf.term, tf.is_train, tf.tf * idf.idf AS w FROM tf JOIN idf USING (term)),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id),
feat AS (SELECT w.doc_id, w.term, w.is_train, w.w / norms.norm AS x FROM w JOIN norms USING (doc_id)),
train_docs AS (SELECT doc_id, label FROM corpus WHERE is_train),
test_docs AS (SELECT doc_id, label FROM corpus WHERE NOT is_train),
classes AS (SELECT label, count(*) AS n FROM train_docs GROUP BY label),
tot AS (SELECT sum(n) AS nn, count(*) AS cc FROM classes),
vsize AS (SELECT count(*) AS v FROM vocab)"""


def nb_sql(kind: str, lam: float) -> str:
    """CTE ``pred(doc_id, label, prediction, score)`` after ``classic_job_ctes``."""
    lam = float(lam)
    if kind == "multinomial":
        stats = f"""ct AS (SELECT d.label, f.term, sum(f.x) AS s FROM feat f JOIN train_docs d USING (doc_id) WHERE f.is_train GROUP BY d.label, f.term),
ctot AS (SELECT label, sum(s) AS t FROM ct GROUP BY label),
consts AS (SELECT c.label, ln(c.n + {lam}) - ln(tot.nn + {lam} * tot.cc) AS lp,
                  ln(coalesce(ctot.t, 0) + {lam} * vsize.v) AS k
           FROM classes c CROSS JOIN tot CROSS JOIN vsize LEFT JOIN ctot USING (label)),
tf_test AS (SELECT f.doc_id, f.term, f.x FROM feat f WHERE NOT f.is_train AND f.term IN (SELECT term FROM ct)),
dx AS (SELECT t.doc_id, c.label AS cls, sum(t.x * ln(coalesce(ct.s, 0) + {lam})) AS s, sum(t.x) AS xs
       FROM tf_test t CROSS JOIN classes c LEFT JOIN ct ON ct.label = c.label AND ct.term = t.term
       GROUP BY t.doc_id, c.label),
scores AS (SELECT d.doc_id, d.label, c.label AS cls, k.lp + coalesce(dx.s, 0) - coalesce(dx.xs, 0) * k.k AS score
           FROM test_docs d CROSS JOIN classes c JOIN consts k ON k.label = c.label
           LEFT JOIN dx ON dx.doc_id = d.doc_id AND dx.cls = c.label)"""
    else:
        stats = f"""ct AS (SELECT d.label, f.term, CAST(count(*) AS DOUBLE) AS s FROM feat f JOIN train_docs d USING (doc_id)
               WHERE f.is_train AND f.x > 0 GROUP BY d.label, f.term),
seen AS (SELECT label, sum(ln(n - s + {lam}) - ln(n + 2 * {lam})) AS q, count(*) AS kk
         FROM ct JOIN classes USING (label) GROUP BY label),
consts AS (SELECT c.label, ln(c.n + {lam}) - ln(tot.nn + {lam} * tot.cc) AS lp,
                  coalesce(seen.q, 0) + (vsize.v - coalesce(seen.kk, 0)) * (ln(c.n + {lam}) - ln(c.n + 2 * {lam})) AS k
           FROM classes c CROSS JOIN tot CROSS JOIN vsize LEFT JOIN seen USING (label)),
tf_test AS (SELECT f.doc_id, f.term FROM feat f WHERE NOT f.is_train AND f.x > 0
            AND f.term IN (SELECT term FROM ct)),
dx AS (SELECT t.doc_id, c.label AS cls, sum(ln(coalesce(ct.s, 0) + {lam}) - ln(c.n - coalesce(ct.s, 0) + {lam})) AS s
       FROM tf_test t CROSS JOIN classes c LEFT JOIN ct ON ct.label = c.label AND ct.term = t.term
       GROUP BY t.doc_id, c.label),
scores AS (SELECT d.doc_id, d.label, c.label AS cls, k.lp + k.k + coalesce(dx.s, 0) AS score
           FROM test_docs d CROSS JOIN classes c JOIN consts k ON k.label = c.label
           LEFT JOIN dx ON dx.doc_id = d.doc_id AND dx.cls = c.label)"""
    return f"""{stats},
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cls ASC) AS rk FROM scores),
pred AS (SELECT doc_id, label, CAST(cls AS DOUBLE) AS prediction, score FROM ranked WHERE rk = 1)"""


def metrics_ctes() -> str:
    """CTEs ``pairs, pc, prf`` over ``pred(label, prediction)``."""
    return """pairs AS (SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n
          FROM pred GROUP BY ALL),
asl AS (SELECT label AS cls, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp, sum(n) AS support
        FROM pairs GROUP BY label),
asp AS (SELECT prediction AS cls, sum(CASE WHEN label <> prediction THEN n ELSE 0 END) AS fp FROM pairs GROUP BY prediction),
pc AS (SELECT coalesce(asl.cls, asp.cls) AS cls, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp,
              coalesce(support, 0) AS support
       FROM asl FULL JOIN asp ON asl.cls = asp.cls),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc),
prf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
        FROM pr)"""


def forest_ctes(num_trees: int = 2, max_depth: int = 5, seed: int = 0) -> str:
    """CTEs after ``classic_job_ctes``: ``best1(tree, node, idx, bin, right_rows, left_rows, score)``, the first split of
    each tree, and so on to the last level; ``pred(doc_id, label, prediction, score)`` of the held-out documents.  Labels are
    0, 1, 2."""
    from ..operators.forest import OCTAVE, OFFSET, POISSON, PRIME

    u = md5_bucket(f"concat(doc_id, '|{seed}|', tree)", 1_000_000)
    drawn = " + ".join(f"CASE WHEN u >= {t} THEN 1 ELSE 0 END" for t in POISSON)
    k = f"((node + tree * 64) * 7919 + {104_729 + 15_485_863 * (seed % 1000)})"
    labels = (0, 1, 2)

    def columns(form: str, sep: str = ", ") -> str:
        return sep.join(form.format(i=i) for i in labels)

    out = f"""ids AS (SELECT term, row_number() OVER (ORDER BY cf DESC, term) - 1 AS idx FROM vocab),
bins AS (SELECT doc_id, idx, CAST(floor(log2(x) * {OCTAVE} + {OFFSET}) AS INTEGER) AS bin FROM feat JOIN ids USING (term)),
share AS (SELECT CAST(floor({PRIME}::BIGINT * greatest(1, CAST(floor(sqrt(v)) AS BIGINT)) / v) AS BIGINT) AS below FROM vsize),
at1 AS (SELECT doc_id, label, tree, is_train, 1::BIGINT AS node, CASE WHEN is_train THEN {drawn} ELSE 0 END AS w
        FROM (SELECT doc_id, label, tree, is_train, {u} AS u FROM corpus CROSS JOIN range({num_trees}) AS r(tree)))"""
    for d in range(1, max_depth + 1):
        out += f""",
total{d} AS (SELECT tree, node, {columns("sum(CASE WHEN label = {i} THEN w ELSE 0 END) AS t{i}")} FROM at{d} WHERE w > 0 GROUP BY tree, node),
open{d} AS (SELECT * FROM total{d} WHERE {columns("CASE WHEN t{i} > 0 THEN 1 ELSE 0 END", " + ")} > 1 AND node >= {2 ** (d - 1)}),
hist{d} AS (SELECT a.tree, a.node, b.idx, b.bin, {columns("sum(CASE WHEN a.label = {i} THEN a.w ELSE 0 END) AS c{i}")}
            FROM at{d} a JOIN open{d} o ON o.tree = a.tree AND o.node = a.node JOIN bins b ON b.doc_id = a.doc_id WHERE a.w > 0 GROUP BY a.tree, a.node, b.idx, b.bin),
right{d} AS (SELECT tree, node, idx, bin, {columns("sum(c{i}) OVER up AS r{i}")} FROM hist{d} WINDOW up AS (PARTITION BY tree, node, idx ORDER BY bin DESC)),
sides{d} AS (SELECT r.*, {columns("r{i}", " + ")} AS r, {columns("(t{i} - r{i})", " + ")} AS l, {columns("t{i}")}, (idx + {k.replace('node', 'r.node').replace('tree', 'r.tree')}) % {PRIME} AS a, {k.replace('node', 'r.node').replace('tree', 'r.tree')} AS k
             FROM right{d} r JOIN open{d} o ON o.tree = r.tree AND o.node = r.node),
best{d} AS (SELECT tree, node, idx, bin, r AS right_rows, l AS left_rows, score
            FROM (SELECT *, ((a * a) % {PRIME} * 48271 + k) % {PRIME} AS h, ({columns("r{i} * r{i}", " + ")}) / r + ({columns("(t{i} - r{i}) * (t{i} - r{i})", " + ")}) / l AS score FROM sides{d} WHERE r > 0 AND l > 0) CROSS JOIN share
            QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY CASE WHEN h < below THEN -1 ELSE h END, score DESC, idx, bin) = 1),
at{d + 1} AS (SELECT a.doc_id, a.label, a.tree, a.is_train, a.w, CASE WHEN s.node IS NULL THEN a.node WHEN b.bin >= s.bin THEN 2 * a.node + 1 ELSE 2 * a.node END AS node
              FROM at{d} a LEFT JOIN best{d} s ON s.tree = a.tree AND s.node = a.node LEFT JOIN bins b ON b.doc_id = a.doc_id AND b.idx = s.idx)"""
    last = max_depth + 1
    return out + f""",
leaf AS (SELECT tree, node, {columns("sum(CASE WHEN label = {i} THEN w ELSE 0 END) / sum(w) AS p{i}")} FROM at{last} WHERE w > 0 GROUP BY tree, node),
prob AS (SELECT a.doc_id, a.label, {columns("sum(p{i}) / " + str(num_trees) + " AS p{i}")} FROM at{last} a JOIN leaf USING (tree, node) WHERE NOT a.is_train GROUP BY a.doc_id, a.label),
pred AS (SELECT doc_id, label, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0.0 WHEN p1 >= p2 THEN 1.0 ELSE 2.0 END AS prediction, greatest(p0, p1, p2) AS score FROM prob)"""
