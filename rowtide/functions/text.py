"""Text, JSON and XML rendering of cells.

These helpers take and give SQL text: the expressions are nested lambdas, and
one parsed text costs the driver far less than thousands of column calls. Use
them as F.expr(image_json("after")).
"""

from pyspark.sql import functions as F

NULL_TEXT = "<nil>"

# Characters with a short or markup escape in payload JSON, in escaping order.
_JSON_COMMON = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
                ("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026")]
# Texts without a character to escape, and those with one that has no short form. Texts of ASCII are told before by
# classes of single characters (`_listed`): Java looks these up in one table instead of asking range by range.
_JSON_PLAIN = r"""r'^[^"\\<>&\x00-\x1f\u2028\u2029]*$'"""
_JSON_ODD = r"r'[\x00-\x08\x0b\x0c\x0e-\x1f\u2028\u2029]'"
# Controls without a short form, and the two line separators.
_JSON_RARE = [c for c in range(0x20) if c not in (0x09, 0x0A, 0x0D)] + [0x2028, 0x2029]
_XML_SPECIAL = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;"),
                ("\t", "&#x9;"), ("\n", "&#xA;"), ("\r", "&#xD;")]


def literal(text):
    """SQL string literal."""
    if len(text) == 1 and ord(text) < 0x20:
        return f"char({ord(text)})" if ord(text) else "decode(X'00', 'UTF-8')"
    if "'" in text:
        return f'r"{text}"'
    return f"r'{text}'"


def replace_all(text, pairs):
    for old, new in pairs:
        text = f"replace({text}, {literal(old)}, {literal(new)})"
    return text


def let(value, name, body):
    """Use an expression's value several times without repeating the expression."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _listed(chars, end):
    """Pattern of texts made of some ASCII characters only."""
    return "r'^[" + "".join(f"\\x{c:02x}" for c in chars) + f"]*{end}'"


_ASCII = _listed(range(0x80), r"\z")
_ASCII_PLAIN = _listed([c for c in range(0x20, 0x80) if chr(c) not in '"\\<>&'], "$")
_ASCII_USUAL = _listed([9, 10, 13, *range(0x20, 0x80)], r"\z")


def json_plain(text):
    """Condition: a JSON string shows the text as it is."""
    return f"({text} RLIKE {_ASCII_PLAIN} OR {text} RLIKE {_JSON_PLAIN})"


def trim_space(col):
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def split_trim(col, sep=","):
    """Split and trim each part (a column). An empty text gives one empty part."""
    return F.transform(F.split(col, sep), trim_space)


def float_text(text, style):
    """Number text of a float cell: style "key" for keys, hash fields, filters
    and XML; style "json" for JSON payloads. Both take the shortest digits; they
    differ in when they switch to an exponent."""
    mantissa, scale = "split_part(fs, 'E', 1)", "coalesce(try_cast(split_part(fs, 'E', 2) AS int), 0)"
    parts = let(
        f"struct(split_part({mantissa}, '.', 1) AS w, "
        f"concat(split_part({mantissa}, '.', 1), split_part({mantissa}, '.', 2)) AS raw, {scale} AS scale)",
        "fp",
        # value = 0.digits * 10^point
        "struct(regexp_replace(regexp_replace(fp.raw, '^0+', ''), '0+$', '') AS digits, "
        "length(fp.w) + fp.scale - (length(fp.raw) - length(regexp_replace(fp.raw, '^0+', ''))) AS point)")
    two = "CASE WHEN abs(fd.point - 1) < 10 THEN concat('0', abs(fd.point - 1)) ELSE string(abs(fd.point - 1)) END"
    if style == "json":
        scientific = "fd.point < -5 OR fd.point > 21"
        size = f"CASE WHEN fd.point < 1 THEN string(abs(fd.point - 1)) ELSE {two} END"
    else:
        scientific = "fd.point < -3 OR fd.point > 6"
        size = two
    spelled = let(let(f"string(abs(try_cast({text} AS double)))", "fs", parts), "fd", f"""CASE
        WHEN {scientific} THEN concat(substr(fd.digits, 1, 1),
          CASE WHEN length(fd.digits) > 1 THEN concat('.', substr(fd.digits, 2)) ELSE '' END,
          CASE WHEN fd.point < 1 THEN 'e-' ELSE 'e+' END, {size})
        WHEN fd.point <= 0 THEN concat('0.', repeat('0', -fd.point), fd.digits)
        WHEN length(fd.digits) <= fd.point THEN concat(fd.digits, repeat('0', fd.point - length(fd.digits)))
        ELSE concat(substr(fd.digits, 1, fd.point), '.', substr(fd.digits, fd.point + 1)) END""")
    # A cell that holds no number is shown as it is.
    raw = json_quote(text) if style == "json" else text
    return (f"CASE WHEN try_cast({text} AS double) IS NULL THEN {raw} WHEN try_cast({text} AS double) = 0 THEN '0' "
            f"WHEN try_cast({text} AS double) < 0 THEN concat('-', {spelled}) ELSE {spelled} END")


def cell_text(cell, null_text=NULL_TEXT):
    """Text of a cell in keys, hash fields and filter comparisons."""
    return (f"CASE WHEN {cell}.value IS NULL THEN '{null_text}' "
            f"WHEN {cell}.type = 'float' THEN {float_text(f'{cell}.value', 'key')} ELSE {cell}.value END")


def json_quote(text):
    """A JSON string. Markup characters are escaped too, so the text is safe in
    a page; controls without a short form are written as lower-case escapes."""
    common = replace_all(text, _JSON_COMMON)
    escapes = ", ".join(f"{literal(chr(c))}, {literal(f'\\u{c:04x}')}" for c in _JSON_RARE)
    rare = (f"array_join(transform(split({common}, ''), jc -> "
            f"coalesce(try_element_at(map({escapes}), jc), jc)), '')")
    return (f"""concat('"', CASE WHEN {json_plain(text)} THEN {text} """
            f"""WHEN NOT {text} RLIKE {_ASCII_USUAL} AND {text} RLIKE {_JSON_ODD} THEN {rare} """
            f"""ELSE {common} END, '"')""")


def json_cell_quote(text):
    """As json_quote, with bytes that are no UTF-8 shown as escapes."""
    broken = let(f"make_valid_utf8({text})", "jv",
                 f"replace({json_quote('jv')}, '�', {literal(chr(92) + 'ufffd')})")
    return f"CASE WHEN {text} RLIKE {_ASCII} OR is_valid_utf8({text}) THEN {json_quote(text)} ELSE {broken} END"


def cell_json(cell, decimal_as="string"):
    """JSON value of a cell: numbers bare, text quoted, NULL as null."""
    bare = "('int', 'decimal')" if decimal_as == "number" else "('int')"
    return (f"CASE WHEN {cell}.value IS NULL THEN 'null' WHEN {cell}.type IN {bare} THEN {cell}.value "
            f"WHEN {cell}.type = 'float' THEN {float_text(f'{cell}.value', 'json')} "
            f"ELSE {json_cell_quote(f'{cell}.value')} END")


def xml_escape(text):
    """Escaped character data and attribute text. Characters XML cannot hold
    become the replacement character."""
    special = (f"regexp_replace({replace_all(text, _XML_SPECIAL)}, "
               f"r'[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]', '�')")
    return (f"""CASE WHEN {text} RLIKE r"^[^&<>\\x22'\\x00-\\x1f\\ufffe\\uffff]*$" THEN {text} ELSE {special} END""")


def cells_of(image, names):
    """The cells of an image named in a list, in the list's order."""
    return f"flatten(transform({names}, cn -> filter({image}, cc -> cc.name = cn)))"


def image_text(image, names, sep=":"):
    """Texts of the named cells joined; names the row does not have are skipped."""
    return f"array_join(transform({cells_of(image, names)}, it -> {cell_text('it')}), '{sep}')"


def texts(image):
    """Name and text of every cell, for jobs that read them several times."""
    return f"transform({image}, tx -> struct(tx.name AS name, {cell_text('tx')} AS text))"


def joined_texts(cells, names, sep=":"):
    """As image_text, over the result of `texts`."""
    return f"array_join(transform({cells_of(cells, names)}, jt -> jt.text), '{sep}')"


def json_heads(names):
    """What stands before the value of each of a list of names in `image_json`."""
    return f"transform({names}, hn -> concat({json_quote('hn')}, ':'))"


def xml_heads(names):
    """What stands before the value of each of a list of names in `image_xml`."""
    return f"""transform({names}, hn -> concat('<column name="', {xml_escape('hn')}, '">'))"""


def image_json(image, names=None, decimal_as="string", heads=None):
    """JSON object of an image, keys in name order. `names` holds the sorted
    distinct names to keep, NULL for all, and `heads`, if given, their `json_heads`."""
    def members(name, cells):
        return (f"array_join(transform({cells}, m -> concat({name}, ':', {cell_json('m', decimal_as)})), ',')")

    # Column names hardly ever need escaping: one look at all of them together.
    plain = json_plain(f"array_join({image}.name, '')")

    def every(cells):
        return (f"""CASE WHEN {plain} THEN {members("'\"', m.name, '\"'", cells)} """
                f"""ELSE {members(json_quote('m.name'), cells)} END""")

    body = every(f"sort_array({image})")
    if heads is not None:
        # The names are looked at once per rule, not once per row.
        body = (f"CASE WHEN {names} IS NULL THEN {body} ELSE array_join(flatten(transform({names}, (cn, ci) -> transform("
                f"filter({image}, cc -> cc.name = cn), m -> concat({heads}[ci], {cell_json('m', decimal_as)})))), ',') END")
    elif names is not None:
        body = every(f"CASE WHEN {names} IS NULL THEN sort_array({image}) ELSE {cells_of(image, names)} END")
    return f"concat('{{', {body}, '}}')"


def image_xml(image, names=None, heads=None):
    """<columns> element of an image, in image order or in the list's order; `heads`
    holds the `xml_heads` of the names, if given."""
    text = let(f"make_valid_utf8({cell_text('xc', '')})", "xv", xml_escape("xv"))

    def every(cells):
        member = f"""concat('<column name="', {xml_escape('xc.name')}, '">', {text}, '</column>')"""
        return f"array_join(transform({cells}, xc -> {member}), '')"

    body = every(image)
    if heads is not None:
        body = (f"CASE WHEN {names} IS NULL THEN {body} ELSE array_join(flatten(transform({names}, (cn, ci) -> transform("
                f"filter({image}, cc -> cc.name = cn), xc -> concat({heads}[ci], {text}, '</column>')))), '') END")
    elif names is not None:
        body = every(f"CASE WHEN {names} IS NULL THEN {image} ELSE {cells_of(image, names)} END")
    return f"concat('<columns>', {body}, '</columns>')"
