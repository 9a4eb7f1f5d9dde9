"""Column expressions for RFC-822 mail text and message lines.

All of these are native Spark expressions (whole-stage codegen, no Python
worker). Semantics follow the standard library's ``email`` parser in its
default (compat32) policy, as the extraction stage used it:

* headers end at the first line that is empty or no header line (a header
  line starts with a name and a colon, or a blank or tab to continue one);
  an empty line is dropped, any other one is the first line of the body;
* a header value starts after ``Name:`` and optional blanks, and takes its
  folded continuation lines (lines starting with a blank or a tab);
* header names match case-insensitively; the first occurrence wins;
  ``X-To:`` is not ``To:``, and a ``To:`` line in the body is not a header.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the line format written by the extraction stage.
FIELD_SEPARATOR = "*"
RECIPIENT_SEPARATOR = ","
TO_END = (1 << 31) - 1     # a length no text exceeds


def normalize_newlines(raw: Column) -> Column:
    """CRLF and lone CR become LF, as a text-mode file read does (the
    regex runs only on texts that hold a CR)."""
    return F.when(F.contains(raw, F.lit("\r")),
                  F.regexp_replace(raw, "\r\n?", "\n")).otherwise(raw)


HEADER_LINES = r"\A(?:(?:From |[!-9;-~]*:|[ \t])[^\n]*(?:\n|\z))*"


def header_block(raw: Column) -> Column:
    """The leading header lines, line ends included. No header line follows an
    empty one, so the regex sees the text up to there and not the body."""
    blank = F.instr(raw, "\n\n")
    head = F.when(blank > 0, raw.substr(F.lit(1), blank)).otherwise(raw)
    return F.regexp_extract(head, HEADER_LINES + "+", 0)


def body_part(raw: Column, headers: Column) -> Column:
    """Text after ``headers`` and one empty line; ``''`` for a header-only mail."""
    at = F.length(headers)
    return raw.substr(F.when(raw.substr(at + 1, F.lit(1)) == "\n", at + 2).otherwise(at + 1), F.lit(TO_END))


def _value_pattern(name: str) -> str:
    return f"(?imd)^{name}:[ \\t]*([^\\n]*(?:\\n[ \\t][^\\n]*)*)"


def has_header(headers: Column, name: str) -> Column:
    return headers.rlike(f"(?imd)^{name}:")


def header_value(headers: Column, name: str) -> Column:
    """First ``name`` header, folded lines included (line breaks kept);
    null when the header is absent."""
    return F.when(has_header(headers, name),
                  F.regexp_extract(headers, _value_pattern(name), 1))


def strip_recipients(value: Column) -> Column:
    """Drop newline, tab and blank from a recipient header value."""
    return F.regexp_replace(value, "[\\n\\t ]", "")


def unfold(value: Column) -> Column:
    """RFC 5322 unfolding: remove the line breaks of folded lines."""
    return F.regexp_replace(value, "\\n", "")


def flatten_body(body: Column) -> Column:
    """Newlines become blanks so one mail is one line."""
    return F.replace(body, F.lit("\n"), F.lit(" "))


def is_multipart(headers: Column) -> Column:
    """The first Content-Type, folded or not, names a multipart with a
    boundary, or a message inside the message."""
    kind = F.coalesce(header_value(headers, "content-type"), F.lit(""))
    return kind.rlike(r"(?is)\A\s*multipart/[^;]*;.*\bboundary\s*=") | kind.rlike(r"(?i)\A\s*message/")


def message_line(sender: Column, to_list: Column, body: Column) -> Column:
    """``sender*to_list*body``; null parts are written empty."""
    sep = F.lit(FIELD_SEPARATOR)
    return F.concat(F.coalesce(sender, F.lit("")), sep,
                    F.coalesce(to_list, F.lit("")), sep,
                    F.coalesce(body, F.lit("")))


def split_fields(line: Column) -> list[Column]:
    """Split a message line into at most 3 fields; the body keeps later
    separators. Missing fields are null. Only the part before the second
    separator is searched, the body is cut off behind it."""
    sep = F.lit(FIELD_SEPARATOR)
    head = F.substring_index(line, FIELD_SEPARATOR, 2)
    return [F.substring_index(head, FIELD_SEPARATOR, 1).alias("sender"),
            F.when(F.contains(head, sep), F.substring_index(head, FIELD_SEPARATOR, -1)).alias("to_list"),
            F.when(F.octet_length(head) < F.octet_length(line),
                   line.substr(F.length(head) + 2, F.lit(TO_END))).alias("body")]
