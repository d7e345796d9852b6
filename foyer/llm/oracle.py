"""The answers of the registered queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations


def _level(name: str, parents: list[str], column: str, above: str | None) -> str:
    """One level of the tree: its nodes with the budget that filling gives them."""
    path = [*parents, column]
    keys = ", ".join(path)
    family = f"PARTITION BY {', '.join(parents)}" if parents else ""
    total = f"a.budget::HUGEINT" if above else "(SELECT sum(own) * 3 // 4 FROM leaves)::HUGEINT"
    join = f"JOIN {above} a ON {' AND '.join(f'n.{c} IS NOT DISTINCT FROM a.{c}' for c in parents)}" if above else ""
    return f"""
{name}_nodes AS (
  SELECT {", ".join("n." + c for c in path)}, max(w_{column})::HUGEINT AS weight, sum(own * 2)::HUGEINT AS tokens, any_value({total}) AS total
  FROM leaves n {join} GROUP BY {", ".join("n." + c for c in path)}),
{name}_below AS (
  SELECT *, sum(tokens) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS below,
    coalesce(sum(weight) OVER (up ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS rest
  FROM {name}_nodes
  WINDOW up AS ({family} ORDER BY tokens::DOUBLE / weight::DOUBLE, {column} NULLS FIRST)),
{name}_full AS (
  SELECT *, below * weight + tokens * rest <= total * weight AS is_full FROM {name}_below),
{name} AS (
  SELECT {keys}, tokens, CASE WHEN is_full THEN tokens ELSE
    (total - coalesce(sum(CASE WHEN is_full THEN tokens END) OVER f, 0)) * weight
      // sum(CASE WHEN NOT is_full THEN weight END) OVER f END AS budget
  FROM {name}_full WINDOW f AS ({family}))"""


_MIXTURE = f"""
WITH docs AS (
  SELECT doc_id, lang, source,
    ['web', 'books', 'code'][TRY_CAST(regexp_extract(source, '[0-9]+') AS INT) % 3 + 1] AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM documents),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens) AS own,
    max(CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END) AS w_domain,
    max(CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 3 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END) AS w_lang,
    1 AS w_source
  FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0),
{_level("by_domain", [], "domain", None)},
{_level("by_lang", ["domain"], "lang", "by_domain")},
{_level("by_source", ["domain", "lang"], "source", "by_lang")},
epochs AS (
  SELECT domain, lang, source, epoch::INT AS epoch,
    CASE WHEN epoch < budget // (tokens // 2) THEN tokens // 2
         WHEN epoch = budget // (tokens // 2) THEN budget % (tokens // 2) ELSE 0 END AS lim
  FROM by_source, range(2) e(epoch) WHERE tokens > 0),
ranked AS (
  SELECT d.*, epoch, lim, sum(n_tokens) OVER (
    PARTITION BY d.domain, d.lang, d.source, epoch ORDER BY md5('7:' || epoch || ':' || doc_id), doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens AS mix_rank
  FROM docs d JOIN epochs e ON d.domain IS NOT DISTINCT FROM e.domain AND d.lang IS NOT DISTINCT FROM e.lang
    AND d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, domain, lang, source, epoch, n_tokens, least(n_tokens, lim - mix_rank)::BIGINT AS taken,
  mix_rank::BIGINT AS mix_rank
FROM ranked WHERE mix_rank < lim"""

ORACLES = {"op10_source_mixture": _MIXTURE}


# crc32 of a key's decimal text: bytes into the register, eight shifts each, over fixed polynomial 0xEDB88320.
_CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce({key}::VARCHAR, ''), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _levels(name: str, leaves: str, levels: int) -> str:
    """The nodes of trees (g, place, node, n) by level, each with what stands before and after it in its run."""
    parts = []
    for k in range(levels):
        if k == 0:
            source = f"SELECT g, place, node, n FROM {leaves}"
        else:
            source = f"""SELECT g, CASE WHEN n > 1 THEN place // 16 ELSE place END AS place,
    CASE WHEN n > 1 THEN sha256(string_agg(node, '' ORDER BY place)) ELSE min(node) END AS node, (n + 15) // 16 AS n
    FROM {name}{k - 1} GROUP BY g, CASE WHEN n > 1 THEN place // 16 ELSE place END, n"""
        parts.append(f"""{name}{k} AS MATERIALIZED (
  SELECT *, coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM ({source}) WINDOW run AS (PARTITION BY g, place // 16 ORDER BY place))""")
    return ",\n".join(parts)


def _climb(name: str, first: str, levels: int, place: str, join: str) -> str:
    """From ``first``, fold ``now`` and gather ``proof`` through the levels."""
    parts, last = [], first
    for k in range(levels):
        parts.append(f"""{first}_{name}{k} AS (
  SELECT x.* EXCLUDE (now, proof), x.proof || t.before || t.after AS proof,
    CASE WHEN t.n > 1 THEN sha256(t.before || x.now || t.after) ELSE x.now END AS now
  FROM {last} x JOIN {name}{k} t ON {join} AND t.place = x.{place} // {16 ** k})""")
        last = f"{first}_{name}{k}"
    return ",\n".join(parts)


#: Levels that hold 16^6 documents a source and 16^3 sources.
_DEEP, _WIDE = 7, 4

_MANIFEST = f"""
WITH docs AS (
  SELECT doc_id, coalesce('1' || source, '0') AS g,
    sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
    CASE WHEN {_CRC.format(key="doc_id")} % 5 = 0 THEN sha256({" || ".join(_field(c) for c in (
      "doc_id", "source", "lang", "n_chars", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
    ))}) END AS seen
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, leaf AS node, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY g) AS n FROM docs),
{_levels("low", "leaves", _DEEP)},
tops AS (SELECT '' AS g, g AS own, node, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM low{_DEEP - 1}),
{_levels("high", "tops", _WIDE)},
start AS (
  SELECT l.doc_id, l.g, l.leaf, l.place, t.place AS shelf, t.node AS subroot, coalesce(l.seen, l.leaf) AS now, '' AS proof
  FROM leaves l JOIN tops t ON l.g = t.own),
{_climb("low", "start", _DEEP, "place", "t.g = x.g")},
{_climb("high", f"start_low{_DEEP - 1}", _WIDE, "shelf", "t.g = ''")}
SELECT doc_id, leaf, subroot, r.node AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = r.node AS verified
FROM start_low{_DEEP - 1}_high{_WIDE - 1}, high{_WIDE - 1} r"""

ORACLES["op11_merkle_manifest"] = _MANIFEST
