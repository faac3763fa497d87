"""The source dialect's functions for SQL text, as SQL-defined temporary functions.

Statements written for the source warehouse call functions that Spark lacks or
defines otherwise. ``register_functions`` creates them in the session; each is an
expression (or a table function) that Spark inlines into the plan, so they run
inside the JVM and no row passes through Python.

* ``strftime(format, value)``: %d %f %H %j %J %m %M %s %S %w %W %Y %%; NULL for a
  value that is no time and for any other letter;
* ``datetime(value)``, ``julianday(value)``, ``unixepoch(value)``;
* ``printf_text(format, ...)``: printf with up to 12 arguments, where NULL prints
  as an empty text (Spark's own ``printf`` prints ``null`` and cannot be replaced);
* ``lenient_int(value)``, ``lenient_real(value)``: CAST with prefix parsing;
* ``json_each(document)``: a table of the elements of a JSON array (key, value);
* ``split_items(text, separator)``: a table of the pieces before each separator, as
  a recursive splitter gives them: what follows the last separator only if it is
  not empty.

A time value is an ISO date with an optional time and zone (a day past its month's
end rolls over), a time alone (on 2000-01-01), or the text of a number: a Julian
day, fractions of a day included, rounded to the millisecond, from year 0 to 9999.

Two things differ in the text of a statement: ``LATERAL`` stands before a table
function that reads columns of the tables to its left, and ``printf`` becomes
``printf_text`` where a NULL may be printed. ``IFNULL``, ``NULLIF``, ``INSTR``,
``SUBSTR``, ``TRIM``, ``REPLACE``, ``||`` and ``WITH RECURSIVE`` are Spark's own. A
recursive statement's depth is bounded by ``spark.sql.cteRecursionLevelLimit`` (100
unless set, or ``MAX RECURSION LEVEL`` in the statement).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

PRINTF_ARGUMENTS = 12

#: Days from the Julian epoch to 1970-01-01, and the first and last days that count.
_EPOCH, _FIRST, _LAST = "2440587.5BD", "1721059.5", "5373484.5"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _time_value(v: str) -> str:
    """A TIMESTAMP_NTZ from the text ``v`` (trimmed)."""
    zone = r"'(?:Z|(?<=:[0-9]{2}) ?([+-])([0-9]{2}):([0-9]{2}))$'"
    minutes = (f"coalesce((try_cast(regexp_extract({v}, {zone}, 2) AS INT) * 60 + try_cast(regexp_extract({v}, {zone}, 3) AS INT))"
               f" * CASE regexp_extract({v}, {zone}, 1) WHEN '-' THEN -1 ELSE 1 END, 0)")
    day = f"try_cast(substr({v}, 9, 2) AS INT)"
    first = f"concat(substr({v}, 1, 8), '01', substr({v}, 11, length({v}) - 10 - length(regexp_extract({v}, {zone}, 0))))"
    zoned = f"(endswith({v}, 'Z') OR (substr({v}, -3, 1) = ':' AND substr({v}, -6, 1) IN ('+', '-')))"
    rolled = f"CASE WHEN {day} BETWEEN 1 AND 31 THEN try_cast({first} AS TIMESTAMP_NTZ) + make_dt_interval({day} - 1, 0, -{minutes}) END"
    seconds = f"CAST(round((n - {_EPOCH}) * 86400, 3) AS DECIMAL(18,6))"
    julian = _let(f"try_cast({v} AS DECIMAL(30,12))", "n",
                  f"CASE WHEN n >= {_FIRST} AND n < {_LAST} THEN timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, {seconds}) END")
    return (f"CASE WHEN {v} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}' THEN coalesce(CASE WHEN NOT {zoned} THEN try_cast({v} AS TIMESTAMP_NTZ) END, {rolled}) "
            f"WHEN {v} RLIKE '^[0-9]{{2}}:[0-9]{{2}}' THEN try_cast('2000-01-01 ' || {v} AS TIMESTAMP_NTZ) "
            f"WHEN {v} RLIKE '^[0-9]+([.][0-9]*)?$' THEN {julian} END")


def _digits(value: str, n: int) -> str:
    return f"lpad(CAST({value} AS STRING), {n}, '0')"


#: Days and microseconds since 1970-01-01 of the time t.
_MICROS = "(datediff(CAST(t AS DATE), DATE'1970-01-01') * 86400000000L + CAST((extract(HOUR FROM t) * 3600 + extract(MINUTE FROM t) * 60 + extract(SECOND FROM t)) * 1000000 AS BIGINT))"
_JULIAN = f"(2440587.5D + {_MICROS} / 86400000000D)"

#: Format letters of a time t.
_LETTERS = {
    "d": _digits("day(t)", 2), "f": "format_string('%02d.%03d', CAST(floor(extract(SECOND FROM t)) AS INT), CAST(floor(extract(SECOND FROM t) * 1000) AS INT) % 1000)",
    "H": _digits("hour(t)", 2), "j": _digits("dayofyear(t)", 3), "J": f"CAST({_JULIAN} AS STRING)", "m": _digits("month(t)", 2),
    "M": _digits("minute(t)", 2), "s": f"CAST({_MICROS} DIV 1000000 AS STRING)", "S": _digits("CAST(floor(second(t)) AS INT)", 2),
    "w": "CAST(dayofweek(t) - 1 AS STRING)", "W": _digits("(dayofyear(t) + 6 - weekday(t)) DIV 7", 2), "Y": _digits("year(t)", 4), "%": "'%'"}

_ISO = "%Y-%m-%d %H:%M:%S"

_INT_HEAD, _REAL_HEAD = "'^[+-]?[0-9]+'", "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'"


def _head(value: str, pattern: str, kind: str, zero: str) -> str:
    head = f"regexp_extract(trim({value}), {pattern}, 0)"
    return f"CASE WHEN {value} IS NULL THEN NULL WHEN {head} = '' THEN {zero} ELSE try_cast({head} AS {kind}) END"


def _functions() -> dict[str, str]:
    """Signature -> body."""
    letters = " ".join(f"WHEN '%{k}' THEN {v}" for k, v in _LETTERS.items())
    pieces = f"transform(regexp_extract_all(fmt, '(?s)%.|[^%]+|%$', 0), p -> CASE p {letters} ELSE CASE WHEN startswith(p, '%') THEN NULL ELSE p END END)"
    whole = _let(pieces, "a", "CASE WHEN exists(a, x -> x IS NULL) THEN NULL ELSE array_join(a, '') END")
    # a format that an ISO time begins with is cut from the time's own text; Spark decides this once for a literal format
    iso = (f"startswith('{_ISO}', fmt) AND length(fmt) % 3 = 2 AND year(t) BETWEEN 0 AND 9999 THEN substr(CAST(t AS STRING), 1, length(fmt) + 2)")
    arguments = [f"a{i}" for i in range(1, PRINTF_ARGUMENTS + 1)]
    mark, value = "element_at(m, i)", "try_element_at(v, i)"
    real, integer = _head(value, _REAL_HEAD, "DOUBLE", "0D"), _head(value, _INT_HEAD, "BIGINT", "0L")
    # texts s before the marks m of the arguments v; behind the last text stands an empty mark
    printed = (f"CASE WHEN {mark} = '' THEN '' WHEN {mark} RLIKE '[di]$' THEN format_string(regexp_replace({mark}, 'i$', 'd'), coalesce({integer}, 0L)) "
               f"WHEN {mark} RLIKE '[feEgG]$' THEN format_string({mark}, coalesce({real}, 0D)) ELSE format_string({mark}, coalesce({value}, '')) END")
    joined = f"array_join(transform(sequence(1, size(m)), i -> concat(element_at(s, i), {printed})), '')"
    pattern = "'%[-+ 0-9.]*[a-zA-Z]'"
    joined = _let(f"split(f, {pattern})", "s", _let(f"concat(regexp_extract_all(f, {pattern}, 0), array(''))", "m",
                                                    _let(f"array({', '.join(arguments)})", "v", joined)))
    pieces_kept = "CASE WHEN list <> '' AND endswith(list, separator) THEN slice(s, 1, size(s) - 1) ELSE s END"
    return {
        "strftime(fmt STRING, value STRING) RETURNS STRING": "RETURN " + _let("trim(value)", "v", _let(_time_value("v"), "t", f"CASE WHEN t IS NULL THEN NULL WHEN {iso} ELSE {whole} END")),
        "datetime(value STRING) RETURNS STRING": "RETURN strftime('%Y-%m-%d %H:%M:%S', value)",
        "julianday(value STRING) RETURNS DOUBLE": "RETURN " + _let("trim(value)", "v", _let(_time_value("v"), "t", _JULIAN)),
        "unixepoch(value STRING) RETURNS BIGINT": "RETURN " + _let("trim(value)", "v", _let(_time_value("v"), "t", f"{_MICROS} DIV 1000000")),
        "lenient_int(value STRING) RETURNS BIGINT": "RETURN " + _head("value", _INT_HEAD, "BIGINT", "0L"),
        "lenient_real(value STRING) RETURNS DOUBLE": "RETURN " + _head("value", _REAL_HEAD, "DOUBLE", "0D"),
        f"printf_text(fmt STRING, {', '.join(f'{a} STRING DEFAULT NULL' for a in arguments)}) RETURNS STRING":
            "RETURN replace(" + _let("replace(fmt, '%%', '\\u0001')", "f", joined) + ", '\\u0001', '%')",
        "json_each(document STRING) RETURNS TABLE(key BIGINT, value STRING)":
            "RETURN SELECT pos, col FROM (SELECT posexplode(from_json(document, 'array<string>')))",
        "split_items(list STRING, separator STRING) RETURNS TABLE(position BIGINT, item STRING)":
            "RETURN SELECT pos, col FROM (SELECT posexplode(" + _let("split(list, '\\\\Q' || separator || '\\\\E')", "s", pieces_kept) + "))",
    }


def register_functions(spark: SparkSession) -> tuple[str, ...]:
    """Creates the functions in the session and returns their names. Recursive
    statements lose their row limit there, which would make them fail at scale."""
    made = _functions()
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    for signature, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} {body}")
    return tuple(s.split("(")[0] for s in made)
