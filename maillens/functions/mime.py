"""MIME structure of mails as column expressions (no Python worker).

A mail's parts are found level by level: every multipart is cut at its
delimiter lines, every ``message/*`` part opens into the message it holds, and
what is neither is a leaf. Leaves are decoded from quoted-printable or base64
and from their charset. Semantics follow the standard library's parser:

* a delimiter is a line ``--boundary``, the last one ``--boundary--``, blanks
  may follow; the line end before a delimiter belongs to it; text before the
  first and behind the last one is dropped; without a last one the final part
  reaches to the end; delimiters in a row hold no part between them;
* a multipart without any delimiter line, and one without a boundary, is a leaf;
* a type that is not ``kind/subkind`` is ``text/plain``, as is a missing one;
* text in an unknown charset, and ASCII, is read as UTF-8; bytes that are no
  UTF-8 become U+FFFD; broken base64 stays as it is written.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from maillens.functions import mail as M

MAX_DEPTH = 8     # levels of nesting that are opened; deeper multiparts stay leaves

# What the two single-byte charsets hold besides ISO-8859-1.
_CP1252 = dict(zip(
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f",
    "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ", strict=True))
_LATIN9 = dict(zip("\xa4\xa6\xa8\xb4\xb8\xbc\xbd\xbe", "€ŠšŽžŒœŸ", strict=True))
_SINGLE_BYTE = {"iso-8859-1": {}, "latin-1": {}, "latin1": {}, "windows-1252": _CP1252, "cp1252": _CP1252,
                "iso-8859-15": _LATIN9, "latin-9": _LATIN9}


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _header(headers: Column, name: str) -> Column:
    return F.coalesce(M.header_value(headers, name), F.lit(""))


def content_type(value: Column) -> Column:
    kind = F.lower(F.regexp_extract(value, r"\A\s*([^;\s]*)", 1))
    return F.when(kind.rlike(r"\A[^/]+/[^/]+\z"), kind).otherwise(F.lit("text/plain"))


def parameter(value: Column, name: str) -> Column:
    """A header's parameter, quoted or not; ``''`` when absent."""
    pattern = rf'(?is);\s*{name}\s*=\s*(?:"([^"]*)"|([^;\s"]+))'
    return F.concat(F.regexp_extract(value, pattern, 1), F.regexp_extract(value, pattern, 2))


def split_message(raw: Column) -> Column:
    """(type, boundary, charset, encoding, body) of a message or part."""
    def opened(headers: Column) -> Column:
        def described(kind: Column) -> Column:
            return F.struct(
                content_type(kind).alias("type"), F.rtrim(parameter(kind, "boundary")).alias("boundary"),
                F.lower(parameter(kind, "charset")).alias("charset"),
                F.lower(F.trim(_header(headers, "content-transfer-encoding"))).alias("encoding"),
                M.body_part(raw, headers).alias("body"))
        return bind(_header(headers, "content-type"), described)
    return bind(M.header_block(raw), opened)


def _delimiter(boundary: Column, end: str) -> Column:
    quoted = F.replace(boundary, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit("(?md)^--\\Q"), quoted, F.lit("\\E" + end))


def children(part: Column) -> Column:
    """The texts of a container's parts; null for a leaf."""
    body, boundary = part["body"], part["boundary"]

    def cut(inner: Column) -> Column:
        pieces = F.split(inner, _delimiter(boundary, "[ \\t]*(?:\\n|\\z)"), -1)
        texts = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
        return F.transform(F.filter(texts, lambda t: t != ""), lambda t: F.regexp_replace(t, "\\n\\z", ""))

    has = F.rlike(body, _delimiter(boundary, "(?:--)?[ \\t]*$"))
    multipart = part["type"].startswith("multipart/") & (boundary != "")
    inner = F.get(F.split(body, _delimiter(boundary, "--[ \\t]*$"), 2), 0)
    return (F.when(multipart, F.when(has, bind(inner, cut)))
            .when(part["type"].startswith("message/"), F.array(body)))


# --- decoding -------------------------------------------------------------------


def quoted_printable(text: Column) -> Column:
    """The bytes of a quoted-printable text."""
    plain = F.regexp_replace(text, "=(?:\\n|\\z)", "")
    byte = lambda p, i: (F.when(i == 0, F.hex(p))
                         .when(p.rlike("\\A[0-9A-Fa-f]{2}"), F.concat(F.upper(F.left(p, F.lit(2))), F.hex(F.substring(p, 3, 1 << 30))))
                         .otherwise(F.concat(F.lit("3D"), F.hex(p))))
    return F.unhex(F.array_join(F.transform(F.split(plain, "=", -1), byte), ""))


def base64(text: Column) -> Column:
    """The bytes of a base64 text, null where it is broken."""
    letters = F.regexp_replace(text, "[^A-Za-z0-9+/]", "")
    padded = F.rpad(letters, (F.ceil(F.length(letters) / 4) * 4).cast("int"), F.lit("="))
    return F.when(letters == "", F.unhex(F.lit(""))).otherwise(F.try_to_binary(padded, F.lit("base64")))


def decoded(data: Column, charset: Column) -> Column:
    """Bytes as text."""
    out = F.make_valid_utf8(data.cast("string"))
    for name, other in _SINGLE_BYTE.items():
        text = F.decode(data, "ISO-8859-1")
        text = F.translate(text, "".join(other), "".join(other.values())) if other else text
        out = F.when(charset == name, text).otherwise(out)
    return out


def leaf_text(part: Column) -> Column:
    """The decoded text of a ``text/*`` leaf, null for other types."""
    body, encoding = part["body"], part["encoding"]
    data = F.when(encoding == "quoted-printable", quoted_printable(body)).when(encoding == "base64", base64(body))
    return F.when(part["type"].startswith("text/") | part["type"].startswith("multipart/"),
                  bind(data, lambda d: F.when(d.isNotNull(), decoded(d, part["charset"])).otherwise(body)))


# --- the tree ---------------------------------------------------------------------


def _numbered(texts: Column, path: Column) -> Column:
    return F.transform(texts, lambda t, i: F.struct(
        F.concat(path, F.when(path == "", F.lit("")).otherwise(F.lit(".")), (i + 1).cast("string")).alias("path"),
        t.alias("raw")))


def parts(raw: Column, max_depth: int = MAX_DEPTH) -> Column:
    """The leaves of a mail, in order: array of (path, type, charset,
    encoding, text). The path counts parts from 1 (``2.1``: first part of the
    second part); a mail without parts is one leaf with an empty path."""
    item = "array<struct<path:string,raw:string>>"
    leaf = "array<struct<path:string,type:string,charset:string,encoding:string,text:string>>"

    def leaves(path: Column, part: Column) -> Column:
        return F.array(F.struct(path.alias("path"), part["type"].alias("type"), part["charset"].alias("charset"),
                                part["encoding"].alias("encoding"), leaf_text(part).alias("text")))

    def step(state: Column) -> Column:
        """One level: what opens goes on, what does not is done."""
        def one(p: Column) -> Column:
            def seen(part: Column) -> Column:
                def kept(inner: Column) -> Column:
                    return F.struct(
                        F.when(inner.isNull(), leaves(p["path"], part)).otherwise(F.array().cast(leaf)).alias("done"),
                        F.when(inner.isNull(), F.array().cast(item)).otherwise(_numbered(inner, p["path"])).alias("open"))
                return bind(children(part), kept)
            return bind(split_message(p["raw"]), seen)

        return bind(F.transform(state["open"], one), lambda got: F.struct(
            F.concat(state["done"], F.flatten(F.transform(got, lambda g: g["done"]))).alias("done"),
            F.flatten(F.transform(got, lambda g: g["open"])).alias("open")))

    start = F.struct(F.array().cast(leaf).alias("done"),
                     F.array(F.struct(F.lit("").alias("path"), raw.alias("raw"))).alias("open"))
    levels = F.aggregate(F.sequence(F.lit(1), F.lit(max_depth)), start,
                         lambda state, _: F.when(F.size(state["open"]) == 0, state).otherwise(step(state)))

    def rest(state: Column) -> Column:
        deep = F.flatten(F.transform(state["open"], lambda p: bind(
            split_message(p["raw"]), lambda part: leaves(p["path"], part))))
        return F.array_sort(F.concat(state["done"], deep), in_order)

    return F.when(raw.isNotNull(), bind(levels, rest))


def in_order(a: Column, b: Column) -> Column:
    """Comparator of leaves by path, part number by part number."""
    key = lambda p: F.transform(F.split(p["path"], "\\."), lambda n: n.try_cast("int"))
    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)
