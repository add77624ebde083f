"""Secret scan: probabilistic automata inferred from labelled credentials score every candidate token."""

from __future__ import annotations

import random
import string
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import text_chunks

ALPHA = 0.05
SLACK = 0.35
EXAMPLES = 300
_END = 128
_HEX, _ALNUM = "0123456789abcdef", string.ascii_letters + string.digits
_B64URL, _B64 = _ALNUM + "-_", _ALNUM + "+/"
#: Characters of candidates, and those of them beside which one may begin or end.
_SEPARATORS = b".:=-+/~_@!#$%^&*?"
_TOKEN = np.zeros(256, bool)
_TOKEN[[*_ALNUM.encode(), *_SEPARATORS]] = True
_APART = np.zeros(256, bool)
_APART[[*_SEPARATORS]] = True


def labelled_credentials(per_format: int = EXAMPLES, seed: int = 17) -> list[tuple[str, str]]:
    """(format, credential): examples of publicly documented credential formats, drawn with a fixed seed."""
    r = random.Random(seed)
    some = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    name = lambda: some(string.ascii_lowercase, r.randrange(3, 10))
    secret = lambda: some(_ALNUM + "!#$%^&*_", r.randrange(8, 21))
    make = {
        "hex_token_40": lambda: some(_HEX, 40),
        "hex_token_40_upper": lambda: some(_HEX.upper(), 40),
        "hex_key_32": lambda: some(_HEX, 32),
        "hex_key_64": lambda: some(_HEX, 64),
        "cloud_access_id": lambda: r.choice(["AKIA", "ASIA"]) + some(string.ascii_uppercase + "234567", 16),
        "forge_token": lambda: r.choice(["ghp_", "gho_", "ghu_", "ghs_"]) + some(_ALNUM, 36),
        "chat_bot_token": lambda: f"xoxb-{some(string.digits, r.randrange(10, 14))}-{some(string.digits, r.randrange(10, 14))}-{some(_ALNUM, 24)}",
        "maps_key": lambda: "AIza" + some(_B64URL, 35),
        "payment_key": lambda: r.choice(["sk_live_", "rk_live_", "sk_test_"]) + some(_ALNUM, r.choice([24, 32, 99])),
        "web_token": lambda: f"eyJ{some(_B64URL, r.randrange(17, 60))}.eyJ{some(_B64URL, r.randrange(20, 200))}.{some(_B64URL, r.choice([43, 64, 86]))}",
        "uuid_key": lambda: "-".join(some(_HEX, n) for n in (8, 4, 4, 4, 12)),
        "private_key_line": lambda: "MII" + r.choice("CEJ") + some(_B64, 60),
        "connection_string": lambda: f"{r.choice(['postgres', 'postgresql', 'mysql', 'mongodb', 'redis', 'amqp'])}://{name()}:{secret()}@{name()}.{name()}:{r.randrange(1000, 65536)}/{name()}",
        "assigned_password": lambda: r.choice(["password", "passwd", "pwd", "secret"]) + r.choice("=:") + secret(),
    }
    return [(name, f()) for name, f in make.items() for _ in range(per_format)]


class Automaton(NamedTuple):
    """``step[state, symbol]`` is the next state or -1, ``logp`` the log-probability; symbol 128 ends the string."""

    step: np.ndarray
    logp: np.ndarray
    least: float  # mean log-probability per symbol that a candidate must reach
    shortest: int  # length of the shortest example


class Tree:
    """A frequency prefix tree that folds states into each other."""

    def __init__(self, words: list[bytes]):
        self.passing: list[int] = [0]
        self.ending: list[int] = [0]
        self.edges: list[dict[int, int]] = [{}]
        self.counts: list[dict[int, int]] = [{}]
        for word in words:
            at = 0
            self.passing[0] += 1
            for symbol in word:
                if symbol not in self.edges[at]:
                    self.edges[at][symbol] = len(self.edges)
                    self.passing.append(0)
                    self.ending.append(0)
                    self.edges.append({})
                    self.counts.append({})
                self.counts[at][symbol] = self.counts[at].get(symbol, 0) + 1
                at = self.edges[at][symbol]
                self.passing[at] += 1
            self.ending[at] += 1

    def alike(self, a: int, b: int, bound: float) -> bool:
        """Whether no outgoing frequency of the two states, or of states reached alike, differs by more than Hoeffding's bound."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.passing[a], self.passing[b]
            if not n or not m:
                continue
            room = bound * (n**-0.5 + m**-0.5)
            if room >= 1:  # no difference of frequencies is that large, here or further on
                continue
            if abs(self.ending[a] / n - self.ending[b] / m) > room:
                return False
            x, y = self.counts[a], self.counts[b]
            for symbol in x.keys() | y.keys():
                if abs(x.get(symbol, 0) / n - y.get(symbol, 0) / m) > room:
                    return False
            todo += [(self.edges[a][s], self.edges[b][s]) for s in self.edges[a].keys() & self.edges[b].keys()]
        return True

    def fold(self, a: int, b: int) -> None:
        """Adds the subtree at b to the state a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.passing[a] += self.passing[b]
            self.ending[a] += self.ending[b]
            for symbol, n in self.counts[b].items():
                self.counts[a][symbol] = self.counts[a].get(symbol, 0) + n
            for symbol, child in self.edges[b].items():
                if symbol in self.edges[a]:
                    todo.append((self.edges[a][symbol], child))
                else:
                    self.edges[a][symbol] = child


def _shape(tree: Tree, state: int) -> np.ndarray:
    """Frequencies of the kinds of symbols that leave a state, and of ending there."""
    out = np.zeros(_KINDS + 1)
    for symbol, n in tree.counts[state].items():
        out[_KIND[symbol]] += n
    out[_KINDS] = tree.ending[state]
    return out / max(1, tree.passing[state])


def infer(words: list[bytes], alpha: float = ALPHA) -> tuple[Tree, list[int]]:
    """The folded tree and its states: red-blue state merging, each blue state into the compatible red one that is most alike.

    If all words have one length, states merge among those of their depth, which
    keeps that length exact. Else a state may also merge with the one that leads to
    it and with those to which that one leads, which makes loops of any number of
    symbols; a state passed by few strings is not taken for one of another part of
    the format that way. Of equally alike states the one that became red first is taken.
    """
    tree = Tree(words)
    layered = len({len(w) for w in words}) < 2
    bound = (0.5 * np.log(2 / alpha)) ** 0.5
    depth = {0: 0}  # of the red states
    shape = {0: _shape(tree, 0)}

    def fringe() -> list[tuple[int, int]]:
        """The (red state, symbol) that lead to blue ones, most frequent first."""
        found = [(p, s) for p in depth for s, child in tree.edges[p].items() if child not in depth]
        return sorted(found, key=lambda x: (depth[x[0]], -tree.counts[x[0]][x[1]], x))

    blue = fringe()
    while blue:
        parent, symbol = blue.pop(0)
        state = tree.edges[parent][symbol]
        if state in depth:
            continue
        level, own = depth[parent] + 1, _shape(tree, state)
        near = set() if layered else {parent, *tree.edges[parent].values()}
        able = [r for r in depth if (depth[r] == level or r in near) and tree.alike(r, state, bound)]
        if able:
            other = min(able, key=lambda r: round(float(np.abs(shape[r] - own).sum()), 9))
            tree.edges[parent][symbol] = other
            tree.fold(other, state)
            if layered:
                shape[other] = _shape(tree, other)
                known = set(blue)
                blue += [x for x in ((other, s) for s in sorted(tree.edges[other])) if x not in known and tree.edges[other][x[1]] not in depth]
            else:  # counts and edges may have changed anywhere
                shape = {r: _shape(tree, r) for r in depth}
                blue = fringe()
        else:
            depth[state], shape[state] = level, own
            blue += [(state, s) for s in sorted(tree.edges[state])]
    return tree, list(depth)


def automaton(words: list[bytes], alpha: float = ALPHA, slack: float = SLACK) -> Automaton:
    """The probabilistic automaton of one format.

    Symbols seen somewhere in the format are smoothed into each state that
    branches, so an unseen mixture of seen symbols keeps a likelihood.
    """
    tree, red = infer(words, alpha)
    number = {state: k for k, state in enumerate(red)}
    step = np.full((len(red), 129), -1, np.int32)
    prob = np.zeros((len(red), 129))
    for state, k in number.items():
        for symbol, child in tree.edges[state].items():
            step[k, symbol] = number[child]
            prob[k, symbol] = tree.counts[state][symbol]
        prob[k, _END] = tree.ending[state]
        step[k, _END] = k if tree.ending[state] else -1
        seen = np.flatnonzero(prob[k, :_END])
        if len(seen) > 4:
            used = np.flatnonzero(np.bincount(np.concatenate([np.frombuffer(w[min(len(w) - 1, 8) :], np.uint8) for w in words]), minlength=_END)[:_END])
            kin = used[np.isin(used, seen) | (np.isin(_KIND[used], _KIND[seen]))]
            target = np.bincount(step[k, seen]).argmax()
            step[k, kin] = np.where(step[k, kin] < 0, target, step[k, kin])
            prob[k, kin] += 1.0
        prob[k] /= max(prob[k].sum(), 1)
    with np.errstate(divide="ignore"):
        made = Automaton(step, np.log(prob), 0.0, min(map(len, words)))
    return made._replace(least=float(likelihoods(words, made).min()) - slack)


_KIND = np.zeros(128, np.int8)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[_KIND == 0] = np.arange(4, 4 + int((_KIND == 0).sum()))
_KINDS = int(_KIND.max()) + 1


def likelihoods(tokens: list[bytes], model: Automaton) -> np.ndarray:
    """Mean log-probability per symbol, the end included; -inf where the automaton has no way."""
    n = np.array([len(t) for t in tokens], np.int64)
    out = np.full(len(tokens), -np.inf)
    order = np.argsort(-n, kind="stable")
    data = np.frombuffer(b"".join(tokens), np.uint8)
    start = np.cumsum(n) - n
    live = order
    state = np.zeros(len(live), np.int64)
    total = np.zeros(len(live))
    for k in range(int(n.max(initial=0)) + 1):
        if not len(live):
            break
        inside = n[live] > k
        symbol = np.full(len(live), _END)
        symbol[inside] = data[start[live[inside]] + k]
        symbol = np.where(symbol > _END, _END, symbol)
        total = total + model.logp[state, symbol]
        done = ~inside
        out[live[done]] = total[done] / (n[live[done]] + 1)
        state = model.step[state, symbol]
        keep = inside & (state >= 0) & np.isfinite(total)
        live, state, total = live[keep], state[keep], total[keep]
    return out


def learn(labelled: list[tuple[str, str]], alpha: float = ALPHA, slack: float = SLACK) -> dict[str, Automaton]:
    """One automaton for each format of the labelled credentials."""
    words: dict[str, list[bytes]] = defaultdict(list)
    for name, word in labelled:
        if word and word.isascii():
            words[name].append(word.encode())
    return {name: automaton(sorted(own), alpha, slack) for name, own in sorted(words.items())}


class Scanner:
    """Scores every candidate of texts by all automata.

    A candidate is a part of a run of token characters that begins at the run's
    start or after a separator and ends at its end or beside a separator; for a
    format it is at least as long as the shortest labelled example. Of the candidates that begin
    at one place the longest that a format accepts is found, of equally long ones
    that of the greatest margin, then of the first name; candidates within an earlier
    found one are part of it.
    """

    def __init__(self, models: dict[str, Automaton]):
        self.names = list(models)
        self.models = [models[n] for n in self.names]
        self.shortest = min((m.shortest for m in self.models), default=1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, str, float]]:
        """(row, start byte, end byte, format, score) of the credentials of one chunk of texts, in order."""
        n = len(data)
        if not n or not self.models:
            return []
        inside = np.zeros(n + 1, bool)
        inside[:n] = _TOKEN[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], inside[:-1]])
        start = np.flatnonzero(inside & (~before | edge))
        stop = np.flatnonzero(before & (~inside | edge))
        long = stop - start >= self.shortest
        start, stop = start[long], stop[long]
        if not len(start):
            return []
        # places within long runs, and of each the end of its run
        size = stop - start
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - start, size)
        end = np.repeat(stop, size)
        first = np.repeat(start, size) == at
        keep = (first | (_APART[data[np.maximum(at - 1, 0)]] & ~_APART[data[at]])) & (end - at >= self.shortest)
        at, end = at[keep], end[keep]
        hits: list[tuple[np.ndarray, ...]] = []
        for k, model in enumerate(self.models):
            live = np.flatnonzero(model.step[0, np.minimum(data[at], _END - 1)] >= 0)
            state, total = np.zeros(len(live), np.int64), np.zeros(len(live))
            done = 0
            while len(live):
                place = at[live] + done
                open_ = place < end[live]
                ends = ~open_ | _APART[data[np.minimum(place, n - 1)]] | _APART[data[place - 1]]
                score = (total + model.logp[state, _END]) / (done + 1)
                good = np.flatnonzero(ends & (score >= model.least) & (done >= model.shortest))
                if len(good):
                    hits.append((live[good], np.full(len(good), done), score[good], score[good] - model.least, np.full(len(good), k)))
                live, state, total, place = live[open_], state[open_], total[open_], place[open_]
                symbol = np.minimum(data[place], _END).astype(np.int64)
                symbol[symbol == _END] = 0
                total = total + model.logp[state, symbol]
                state = model.step[state, symbol]
                ok = (state >= 0) & np.isfinite(total)
                live, state, total = live[ok], state[ok], total[ok]
                done += 1
        if not hits:
            return []
        which, length, score, margin, name = (np.concatenate(x) for x in zip(*hits))
        order = np.lexsort((name, -margin, -length, which))
        out, reached, last = [], -1, -1
        for k in order.tolist():
            a = int(at[which[k]])
            if which[k] == last or a < reached:
                continue
            last, reached = which[k], a + int(length[k])
            out.append((int(np.searchsorted(offsets, a, "right")) - 1, a, reached, self.names[name[k]], float(score[k])))
        return [(r, a - int(offsets[r]), b - int(offsets[r]), f, s) for r, a, b, f, s in out]


def scan(texts: list[bytes], models: dict[str, Automaton]) -> list[tuple[int, int, int, str, float]]:
    """(row, start, end, format, score) of the credentials of some texts."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return Scanner(models)(np.frombuffer(b"".join(texts), np.uint8), offsets)


def examples(spark: SparkSession, labelled: list[tuple[str, str]] | DataFrame | None, most: int) -> list[tuple[str, str]]:
    """The labelled credentials: a list as it is, of a table (format, credential) at most ``most`` of each format, chosen by a hash."""
    if labelled is None:
        return labelled_credentials()
    if isinstance(labelled, list):
        return labelled
    rows = labelled.select(F.col("format").cast("string").alias("format"), F.col("credential").cast("string").alias("credential")).where("format IS NOT NULL AND credential <> ''").distinct()
    out: list[tuple[str, str]] = []
    for r in rows.select("format").distinct().orderBy("format").collect():
        some = rows.where(F.col("format") == r.format).orderBy(F.xxhash64("credential"), "credential").limit(most)
        out += [(x.format, x.credential) for x in some.collect()]
    return out


def _found_rows(batches: Iterator[pa.RecordBatch], models: dict[str, Automaton]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(models)
    for batch in batches:
        for at, _, data, offsets in text_chunks(batch.column(1)):
            found = scanner(data, offsets)
            if found:
                row, start, end, name, score = zip(*found)
                chars = [len(data[offsets[r] : offsets[r] + a].tobytes().decode()) for r, a in zip(row, start)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([at + r for r in row])), pa.array(chars, pa.int32()), pa.array([b - a for a, b in zip(start, end)], pa.int32()), pa.array(name), pa.array([round(x, 6) for x in score])],
                    names=["doc_id", "start", "length", "format", "score"],
                )


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: list[tuple[str, str]] | DataFrame | None = None, *, alpha: float = ALPHA, slack: float = SLACK,
    max_examples: int = EXAMPLES,
) -> DataFrame:
    """(doc_id, start, length, format, score): each credential in each text; ``start`` counts characters from 0.

    For each format of the labelled credentials, given as a list or a table
    (format, credential) of which ``max_examples`` a format are used, prefix-tree
    states with compatible frequencies are merged into a probabilistic automaton.
    Every part of a run of token characters between separators is a candidate of
    each format whose shortest labelled example is not longer, and is scored by it; it
    counts if its mean log-probability per symbol reaches a format's floor, the
    least of that format's examples less ``slack``.

    Null and empty texts have no candidate; rows with a null id are searched and
    named null; repeated rows give their credentials each; of candidates with one
    start the longest counts, equally long ones go to the format of the greatest
    margin over its floor, equal margins to the format whose name comes first; an empty table gives no row; other columns
    are ignored; without labelled credentials nothing is found. The credentials themselves are not in the result.
    """
    spark = docs.sparkSession
    models = spark.sparkContext.broadcast(learn(examples(spark, labelled, max_examples), alpha, slack))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(lambda it: _found_rows(it, models.value), "doc_id bigint, start int, length int, format string, score double")


def mask(text: bytes, found: list[tuple[int, int, str]]) -> bytes:
    out, at = [], 0
    for start, end, name in found:
        out += [text[at:start], b"[", name.encode(), b"]"]
        at = end
    return b"".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", labelled: list[tuple[str, str]] | DataFrame | None = None, *, max_examples: int = EXAMPLES) -> DataFrame:
    """``docs`` with every credential in its text replaced by ``[format]``; ``length_col``, where present, is the new length in characters.

    Rows and columns stay; texts without credentials, null and empty ones are unchanged.
    """
    models = docs.sparkSession.sparkContext.broadcast(learn(examples(docs.sparkSession, labelled, max_examples)))
    names, schema = docs.columns, docs.schema
    place = names.index(text_col)
    count = names.index(length_col) if length_col in names else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(models.value)
        for batch in batches:
            by_row: dict[int, list] = defaultdict(list)
            column = batch.column(place).cast(pa.large_string())
            for at, _, data, offsets in text_chunks(column):
                for r, a, b, name, _ in scanner(data, offsets):
                    by_row[at + r].append((a, b, name))
            if by_row:
                cols = batch.columns
                new = cols[place].to_pylist()
                for r, found in by_row.items():
                    new[r] = mask(new[r].encode(), found).decode()
                cols[place] = pa.array(new, cols[place].type)
                if count is not None:
                    n = cols[count].to_pylist()
                    for r in by_row:
                        n[r] = len(new[r])
                    cols[count] = pa.array(n, cols[count].type)
                batch = pa.RecordBatch.from_arrays(cols, schema=batch.schema)
            yield batch

    return docs.mapInArrow(rows, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
