"""Path algebra on string columns (``/``-separated, optional ``scheme:``).

Everything is built from ``split``/``slice``/``substring``; a path never
leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_slash(c: Column) -> Column:
    """Drop trailing slashes, but keep a lone ``/``."""
    stripped = F.regexp_replace(c, "/+$", "")
    return F.when(stripped == "", F.lit("/")).otherwise(stripped)


def strip_slash_str(p: str) -> str:
    """Python form of ``strip_slash`` for driver-side values."""
    s = p.rstrip("/")
    return s or "/"


def parent_path(c: Column) -> Column:
    """Folder holding the entry; ``/x`` -> ``/``; ``/`` -> NULL."""
    p = strip_slash(c)
    up = F.regexp_replace(p, "/[^/]*$", "")
    return (F.when(p == "/", F.lit(None).cast("string"))
             .when(up == "", F.lit("/"))
             .when(up.endswith(":"), F.concat(up, F.lit("/")))
             .otherwise(up))


def parent_str(p: str) -> str | None:
    """Python form of ``parent_path`` for driver-side values."""
    s = strip_slash_str(p)
    if s == "/":
        return None
    up = s.rsplit("/", 1)[0]
    if up == "":
        return "/"
    if up.endswith(":"):
        return up + "/"
    return up


def base_name(c: Column) -> Column:
    """Last part of the path."""
    return F.substring_index(strip_slash(c), "/", -1)


def is_under(c: Column, root: str) -> Column:
    """True for the root itself and everything below it."""
    r = strip_slash_str(root)
    prefix = r if r.endswith("/") else r + "/"
    return (c == F.lit(r)) | c.startswith(prefix)


def rebase_path(c: Column, source_root: str, dest_root: str) -> Column:
    """Destination of an entry below ``source_root`` when the tree is copied
    into ``dest_root``.  The source folder's own name is kept below the
    destination: ``/data/in/a.txt`` copied from ``/data/in`` to ``/bak``
    goes to ``/bak/in/a.txt``.  A root without a parent (``/``) is its own
    base.  An entry outside the source root fails the job rather than
    being written to its own absolute path.
    """
    root = strip_slash_str(source_root)
    base = parent_str(root) or root
    base_prefix = base if base.endswith("/") else base + "/"
    dest = strip_slash_str(dest_root)
    dest_prefix = dest if dest.endswith("/") else dest + "/"
    p = strip_slash(c)
    rel = F.substring(p, len(base_prefix) + 1, 1 << 30)
    rebased = F.when(p == F.lit(base), F.lit(dest)).otherwise(F.concat(F.lit(dest_prefix), rel))
    return F.when(is_under(p, root), rebased).otherwise(
        F.raise_error(F.concat(F.lit(f"entry outside the source root {root}: "), c)).cast("string"))


def parent_chain(c: Column, root: str) -> Column:
    """All folders above the entry that are at or below ``root``, top first.

    ``/web/h/en/p.html`` with root ``/web`` gives
    ``[/web, /web/h, /web/h/en]``.
    """
    r = strip_slash_str(root)
    prefix = r if r.endswith("/") else r + "/"
    parts = F.split(strip_slash(c), "/")
    n = F.size(parts)
    chain = F.transform(F.sequence(F.lit(2), n - 1),
                        lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    chain = F.when(n > 2, chain).otherwise(F.array().cast("array<string>"))
    return F.filter(chain, lambda p: (p == F.lit(r)) | p.startswith(prefix))


def glob_to_regex(pattern: str) -> str:
    """A path glob as an anchored Java regular expression.

    ``*`` matches within one path part, ``?`` one character of a part,
    ``[abc]`` / ``[!abc]`` / ``[^abc]`` a character class, ``{a,b}`` one of
    the alternatives (may nest), ``\\`` escapes the next character.
    """
    out, i, depth = ["^"], 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            out.append("\\" + pattern[i + 1] if not pattern[i + 1].isalnum() else pattern[i + 1])
            i += 2
            continue
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[":
            j = pattern.find("]", i + 1)
            if j < 0:
                out.append("\\[")
            else:
                body = pattern[i + 1:j]
                if body[:1] in ("!", "^"):
                    body = "^" + body[1:]
                out.append("[" + body.replace("\\", "\\\\") + "]")
                i = j
        elif c == "{":
            out.append("(?:")
            depth += 1
        elif c == "}" and depth:
            out.append(")")
            depth -= 1
        elif c == "," and depth:
            out.append("|")
        elif c in ".^$+|()[]{}":
            out.append("\\" + c)
        else:
            out.append(c)
        i += 1
    out.append("$")
    return "".join(out)
