"""URL filters by a bit-parallel wildcard automaton (Shift-And over many words).

All globs are laid out in one bit string, a bit per literal position, and packed
into 64-bit words. A step over one character of every URL of a batch shifts the
states, keeps the bits whose literal equals the character, and lets the bits that
stand before a star stay. So all patterns advance at once on all URLs, and the
work per character does not depend on what matched before.

Globs: ``**`` stands for any run of characters, ``*`` for a run without ``/``,
``?`` for one character; everything else, upper case included, is literal. A glob
has to match the whole canonical URL: ``.`` + host + path. Empty globs and nulls
are refused. Null or malformed URLs have an empty host and path and the canonical
form ``.``; such a row fits no rule and is judged by the globs like others.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.text import in_batches

#: Fixed values of the query contract: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Globs that block a URL which no rule fits.
BLOCKED = [
    "*spam*/**",
    "*cheap-pills*/**",
    "*.casino*/**",
    "**/wp-login.php**",
    "**.exe",
]
_ALPHABET = 256


class Automaton(NamedTuple):
    """Bit masks of all globs, least significant bit first, in ``width`` words."""

    width: int
    accept: np.ndarray  # for each byte, the bits whose literal takes it
    stay: np.ndarray  # for each byte, the bits that a star before them keeps alive
    first: np.ndarray  # bits alive before the first character
    ends: list[tuple[int, int]]  # word and bit of each glob's end


def _items(glob: str) -> list[tuple[str, bytes]]:
    if not glob:
        raise ValueError("an empty glob matches nothing")
    out, raw, at = [], glob.encode(), 0
    while at < len(raw):
        if raw[at : at + 2] == b"**":
            out.append(("all", b""))
            at += 2
        elif raw[at : at + 1] == b"*":
            out.append(("part", b""))
            at += 1
        else:
            out.append(("one" if raw[at : at + 1] == b"?" else "byte", raw[at : at + 1]))
            at += 1
    return out


def compile_globs(globs: list[str]) -> Automaton:
    """A glob of m characters takes m + 1 bits: state j has read j of them.

    ``?`` takes one byte that starts a character and any bytes that continue it.
    """
    layout = []
    at = 0
    for glob in globs:
        chars, stars = [], {}
        for kind, byte in _items(glob):
            if kind in ("all", "part"):
                stars[len(chars)] = "all" if "all" in (kind, stars.get(len(chars))) else "part"
            else:
                chars.append((kind, byte))
        layout.append((at, chars, stars))
        at += len(chars) + 1
    width = max(1, -(-at // 64))
    accept = np.zeros((_ALPHABET, width), np.uint64)
    stay = np.zeros((_ALPHABET, width), np.uint64)
    first = np.zeros(width, np.uint64)
    starts_char = [b for b in range(_ALPHABET) if b & 0xC0 != 0x80]
    ends = []
    for base, chars, stars in layout:
        word, bit = divmod(base, 64)
        first[word] |= np.uint64(1 << bit)
        for j, (kind, byte) in enumerate(chars):
            word, bit = divmod(base + j + 1, 64)
            for b in starts_char if kind == "one" else [byte[0]]:
                accept[b, word] |= np.uint64(1 << bit)
            if kind == "one":
                for b in range(0x80, 0xC0):
                    stay[b, word] |= np.uint64(1 << bit)
        for j, kind in stars.items():
            word, bit = divmod(base + j, 64)
            for b in range(_ALPHABET):
                if kind == "all" or b != ord("/"):
                    stay[b, word] |= np.uint64(1 << bit)
        ends.append(divmod(base + len(chars), 64))
    return Automaton(width, accept, stay, first, ends)


def run_automaton(machine: Automaton, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, which globs match it: a boolean matrix (texts, globs)."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begins, sizes = offsets[:-1][order], lengths[order]
    state = np.repeat(machine.first[None, :], len(order), axis=0)
    alive = len(order)
    for step in range(int(sizes[0]) if len(sizes) else 0):
        alive = int(np.searchsorted(-sizes[:alive], -step, "left"))
        char = data[begins[:alive] + step]
        now = state[:alive]
        moved = now << np.uint64(1)
        moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
        state[:alive] = (moved & machine.accept[char]) | (now & machine.stay[char])
    found = np.zeros((len(order), len(machine.ends)), bool)
    for g, (word, bit) in enumerate(machine.ends):
        found[order, g] = (state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1
    return found


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.when(F.locate("://", url) > 0, F.split(_rest(url), "[/?#]", 2)[0]).otherwise("")
    return F.translate(F.coalesce(raw, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    whole = F.split(_rest(url), "[?#]", 2)[0]
    start = F.length(F.split(_rest(url), "[/?#]", 2)[0]) + 1
    return F.coalesce(F.when(F.locate("://", url) > 0, F.substring(whole, start, F.length(whole))), F.lit(""))


def _rest(url: Column) -> Column:
    return F.substring(url, F.locate("://", url) + 3, F.length(url))


def rule_globs(rules: list[tuple[str, str, str]]) -> list[str]:
    """A rule fits its host and all subdomains below paths that start like its own."""
    for _, name, start in rules:
        if any(c in "*?" for c in name + start):
            raise ValueError("hosts and paths of rules are literal")
    return [f"*.{name}{start}**" for _, name, start in rules]


def judge(
    pages: DataFrame,
    url: str = "url",
    rules: list[tuple[str, str, str]] = RULES,
    blocked: list[str] = BLOCKED,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``globs``.

    The longest rule that fits gives the verdict; of equally long ones the first.
    Where none fits, a URL is blocked if any glob of ``blocked`` matches and
    allowed otherwise; ``globs`` lists those that match, sorted. Rows are neither
    dropped nor merged, and columns of the input that have a result's name are
    replaced. One narrow pass: no shuffle, whatever the number of patterns.
    """
    names = ["host", "path", "rule", "verdict", "globs"]
    machine = compile_globs([*rule_globs(rules), *blocked])
    labels = [f"{name}{start}" for _, name, start in rules]
    order = sorted(range(len(rules)), key=lambda i: -len(labels[i]))
    verdicts = [verdict for verdict, _, _ in rules]
    by_name = sorted(range(len(blocked)), key=lambda i: blocked[i])

    kept = [c for c in pages.columns if c.lower() not in names]
    parts = pages.select(*(pages[f"`{c}`"] for c in kept), host(pages[f"`{url}`"]).alias("host"), path(pages[f"`{url}`"]).alias("path"))
    columns = parts.select(*(parts[f"`{c}`"] for c in kept)).schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in columns), "host string, path string, rule string, verdict string, globs array<string>"])

    def work(batches):
        for batch in batches:
            hosts, paths = batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()
            texts = [f".{h}{p}".encode() for h, p in zip(hosts, paths, strict=True)]
            offsets = np.zeros(len(texts) + 1, np.int64)
            np.cumsum([len(t) for t in texts], out=offsets[1:])
            found = run_automaton(machine, np.frombuffer(b"".join(texts), np.uint8), offsets)
            rule, verdict, globs = [], [], []
            for row in found:
                best = next((i for i in order if row[i]), None)
                hits = [blocked[i] for i in by_name if row[len(rules) + i]]
                rule.append(None if best is None else labels[best])
                verdict.append(verdicts[best] if best is not None else "block" if hits else "allow")
                globs.append(hits)
            arrays = [batch.column(i) for i in range(len(kept) + 2)]
            arrays += [pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(globs, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])

    return in_batches(parts, work, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """``op9_url_filters``: every page's URL under the fixed rules and the globs."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    judged = judge(pages)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.array_join("globs", ",").alias("globs"))


SQL = r"""
with parts as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), cut as (
  select page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) as path
  from parts
), clean as (
  select page_id, coalesce(host, '') as host, coalesce(path, '') as path from cut
), judged as (
  select *, '.' || host || path as canonical,
    case when ('.' || host) like '%.example.org' and starts_with(path, '/en/1') then 'example.org/en/1'
         when ('.' || host) like '%.example.org' and starts_with(path, '/es/') then 'example.org/es/'
         when ('.' || host) like '%.com' and starts_with(path, '/fr/') then 'com/fr/'
         when ('.' || host) like '%.com' and starts_with(path, '/de/') then 'com/de/'
         when ('.' || host) like '%.org' and starts_with(path, '/') then 'org/' end as rule
  from clean
), globbed as (
  select *, concat_ws(',',
    case when canonical like '%.exe' then '**.exe' end,
    case when contains(canonical, '/wp-login.php') then '**/wp-login.php**' end,
    case when regexp_matches(canonical, '^[^/]*\.casino[^/]*/') then '*.casino*/**' end,
    case when regexp_matches(canonical, '^[^/]*cheap-pills[^/]*/') then '*cheap-pills*/**' end,
    case when regexp_matches(canonical, '^[^/]*spam[^/]*/') then '*spam*/**' end) as globs
  from judged
)
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null or globs <> '' then 'block' else 'allow' end as verdict,
  globs
from globbed
"""
