"""URL filters by a bit-parallel wildcard automaton.

All glob rules (``*``: any bytes, ``?``: one byte) are packed into multiword Shift-And masks. One state vector per URL
simulates every pattern at once, byte by byte, over the canonical URL (host in lower case plus path, without scheme,
query and fragment). Host rules are compiled to globs too; as a glob's ``*`` could run past the host, a rule that the
automaton reports is confirmed exactly on host and path.

Null, empty or scheme-less URLs have an empty host and path: no rule fits and the default verdict holds.
Repeated rows and ties keep their own result rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (verdict, rule): a rule is a host and a path prefix; it fits the host and its subdomains, the longest wins.
HOST_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Globs over host and path that block a URL for which no host rule decides.
BLOCK_GLOBS = ("*/ads/*", "ads.*", "*.ads.*", "*/adserver/*", "*doubleclick.*", "*casino*", "*viagra*", "*porn*", "*/wp-login*", "*/wp-admin/*", "*/cgi-bin/*", "*phishing*", "*.exe", "*.apk", "*/login?/*")


@dataclass(frozen=True)
class GlobAutomaton:
    """Shift-And masks of all globs: bit 0 of each pattern is its start, one more bit for each byte or ``?``."""

    masks: np.ndarray  # (256, words)
    loops: np.ndarray  # states that a following * keeps alive
    starts: np.ndarray
    ends: tuple[int, ...]

    @classmethod
    def compiled(cls, globs: list[str]) -> GlobAutomaton:
        n = sum(1 + sum(b != ord("*") for b in g.encode()) for g in globs)
        words = max(1, -(-n // 64))
        masks, loops, starts, ends, at = np.zeros((256, words), np.uint64), np.zeros(words, np.uint64), np.zeros(words, np.uint64), [], 0

        def put(row, bit):
            row[bit // 64] |= np.uint64(1 << (bit % 64))

        for g in globs:
            put(starts, at)
            for b in g.encode():
                if b == ord("*"):
                    put(loops, at)
                    continue
                at += 1
                for c in range(256) if b == ord("?") else (b,):
                    put(masks[c], at)
            ends.append(at)
            at += 1
        return cls(masks, loops, starts, tuple(ends))

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """(texts, globs) booleans. Texts are advanced together; each drops out at its end."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        ends = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(texts), np.uint8)
        state = np.tile(self.starts, (len(texts), 1))
        begin, length = ends[order], sizes[order]
        one, top = np.uint64(1), np.uint64(63)
        for j in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-length, -j, side="left"))
            d = state[:live]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[:live] = (moved & self.masks[flat[begin[:live] + j]]) | (d & self.loops)
        out = np.empty((len(texts), len(self.ends)), bool)
        for k, e in enumerate(self.ends):
            out[order, k] = (state[:, e // 64] >> np.uint64(e % 64)) & one != 0
        return out


def host_of(url):
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url):
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def judged(pages: DataFrame, host_rules=HOST_RULES, block_globs=BLOCK_GLOBS, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict, glob`` for each row of ``pages``."""
    rules = sorted(host_rules, key=lambda r: (-len(r[1]), r[1]))
    parts = [(r.partition("/")[0], "/" + r.partition("/")[2]) for _, r in rules]
    globs = [f"*.{h}{p}*" for h, p in parts] + [x for g in block_globs for x in (f".{g}",)]
    masks = GlobAutomaton.compiled(globs)
    n_rules = len(rules)

    @F.pandas_udf("rule int, glob int")
    def automaton(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = masks.matches([f".{h}{p}".encode() for h, p in zip(hosts, paths, strict=True)])
        rule = np.full(len(hosts), -1)
        for k in reversed(range(n_rules)):
            h, p = parts[k]
            for i in np.flatnonzero(found[:, k]):
                if f".{hosts.iloc[i]}".endswith(f".{h}") and paths.iloc[i].startswith(p):
                    rule[i] = k
        own = found[:, n_rules:]
        return pd.DataFrame({"rule": rule, "glob": np.where(own.any(axis=1), own.argmax(axis=1) if own.shape[1] else -1, -1)})

    url = F.coalesce(F.col("url"), F.lit(""))
    found = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path")).withColumn("m", automaton("host", "path"))
    names = F.array(*[F.lit(r) for _, r in rules]) if rules else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(v) for v, _ in rules]) if rules else F.array().cast("array<string>")
    shown = F.array(*[F.lit(g) for g in block_globs]) if block_globs else F.array().cast("array<string>")
    rule, glob = F.col("m.rule"), F.col("m.glob")
    return found.select(
        "page_id", "host", "path",
        F.when(rule >= 0, F.get(names, rule)).alias("rule"),
        F.when(rule >= 0, F.get(verdicts, rule)).when(glob >= 0, "block").otherwise(default).alias("verdict"),
        F.when(glob >= 0, F.get(shown, glob)).alias("glob"),
    )


def oracle(host_rules=HOST_RULES, block_globs=BLOCK_GLOBS, default: str = "allow") -> str:
    """The same by string functions of DuckDB."""
    rules = sorted(host_rules, key=lambda r: (-len(r[1]), r[1]))
    fits = [(v, r, f"(suffix('.' || host, '.{r.partition('/')[0]}') AND starts_with(path, '/{r.partition('/')[2]}'))") for v, r in rules]
    globs = [(g, f"(host || path GLOB '{g}')") for g in block_globs]
    return f"""
WITH u AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path,
CASE {' '.join(f"WHEN {c} THEN '{r}'" for _, r, c in fits)} END AS rule,
CASE {' '.join(f"WHEN {c} THEN '{v}'" for v, _, c in fits)} WHEN {' OR '.join(c for _, c in globs)} THEN 'block' ELSE '{default}' END AS verdict,
CASE {' '.join(f"WHEN {c} THEN '{g}'" for g, c in globs)} END AS glob
FROM h"""
