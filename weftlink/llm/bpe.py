"""Byte-level BPE as a lazily determinised transducer, and a streaming UTF-8 decoder.

A sequence of tokens is the BPE encoding of its bytes exactly if every token encodes
to itself and every adjacent pair encodes to that pair. The encoder is the finite-state
transducer of that property: hypotheses walk the vocabulary's trie in parallel, one for
each place where the pending token may have begun; the subset of live hypotheses is a
state of the deterministic machine, built when first reached and then reused. Every arc
names the last token of the prefix read so far, and tokens are emitted once a single
hypothesis is left, so the lookahead is bounded by the vocabulary's overlapping tokens.

Contract of encode_table: null and empty texts give no tokens; rows are mapped one to
one, so repeated rows give repeated results and an empty table gives an empty one; extra
columns are dropped, also those named like an output. Every text is processed whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from weftlink.llm.common import light_batches, tidy, worker_state

#: Entries a worker's cache of split pieces, and of transitions, may reach before it starts anew.
CACHE_PIECES = 250_000
CACHE_ARCS = 400_000
DECODE_CHUNK = 8192
_ROOT = 0
_NODE = (1 << 20) - 1
_NEVER = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64 and id on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class MergeTransducer:
    """Encodes one piece of bytes; states and arcs come into being as they are needed."""

    def __init__(self, ranks: dict[bytes, int], max_arcs: int = CACHE_ARCS):
        self.ranks, self.max_arcs = ranks, max_arcs
        self.by_id = {rank: token for token, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for token, rank in ranks.items():
            node = _ROOT
            for byte in token:
                step = self.children[node].get(byte)
                if step is None:
                    step = len(self.children)
                    self.children[node][byte] = step
                    self.children.append({})
                    self.token_at.append(-1)
                node = step
            self.token_at[node] = rank
        self.ends: dict[int, tuple] = {}
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        # A hypothesis is (token before it + 1) << 20 | trie node; a state is a tuple of hypotheses.
        start = (_ROOT,)
        self.state_ids = {start: 0}
        self.states = [start]
        self.arcs: dict[int, tuple[int, int, bool]] = {}
        self.pairs.clear()

    def merge(self, piece: bytes) -> list[int]:
        """Plain merging, lowest rank first: the definition the machine is compiled from."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
            if best == _NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[x] for x in parts]

    def _ends(self, token: int) -> tuple[bool, list[tuple[bytes, int]], list[tuple[bytes, int]]]:
        """Whether a token encodes to itself; the parts that its merging has at the left and
        at the right end, each with the rank of the merge that swallows it (last: none does).

        A merge makes only merges of higher rank possible, so ranks rise along each list.
        """
        found = self.ends.get(token)
        if found is None:
            piece = self.by_id[token]
            parts = [piece[i : i + 1] for i in range(len(piece))]
            left, right = [], []
            while len(parts) > 1:
                rank, at = min((self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
                if rank == _NEVER:
                    break
                if at == 0:
                    left.append((parts[0], rank))
                if at == len(parts) - 2:
                    right.append((parts[-1], rank))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = self.ends[token] = (len(parts) == 1, [*left, (parts[0], _NEVER)], [*right, (parts[-1], _NEVER)])
        return found

    def _adjacent(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border when two tokens' bytes are merged together."""
        if left < 0:
            return True
        found = self.pairs.get(left << 20 | right)
        if found is None:
            ours, theirs = self._ends(left)[2], self._ends(right)[1]
            i = j = 0
            while True:
                (a, a_gone), (b, b_gone) = ours[i], theirs[j]
                crossing = self.ranks.get(a + b, _NEVER)
                if crossing < a_gone and crossing <= b_gone and crossing != _NEVER:
                    found = False
                elif a_gone == b_gone == _NEVER:
                    found = True
                elif a_gone <= b_gone:
                    i += 1
                    continue
                else:
                    j += 1
                    continue
                break
            self.pairs[left << 20 | right] = found
        return found

    def _arc(self, state: int, byte: int) -> tuple[int, int, bool]:
        """Next state, the token that ends here (each prefix has one last token, or -1), and
        whether all live hypotheses now begin here, so that the tokens so far are final."""
        children, token_at, live, closing = self.children, self.token_at, [], -1
        for hypothesis in self.states[state]:
            step = children[hypothesis & _NODE].get(byte)
            if step is None:
                continue
            if closing < 0 <= token_at[step]:
                token = token_at[step]
                if self._ends(token)[0] and self._adjacent((hypothesis >> 20) - 1, token):
                    closing = token
            if children[step]:
                live.append(hypothesis >> 20 << 20 | step)
        live.append((closing + 1) << 20 | _ROOT)
        reached = tuple(live)
        where = self.state_ids.get(reached)
        if where is None:
            where = self.state_ids[reached] = len(self.states)
            self.states.append(reached)
        arc = self.arcs[state << 8 | byte] = (where, closing, len(live) == 1)
        return arc

    def _settle(self, closed: list[int], out: list[int]) -> None:
        """Read the tokens back from the last one; each leads to the one before it."""
        begin, at = len(out), len(closed)
        while at:
            token = closed[at - 1]
            out.append(token)
            at -= len(self.by_id[token])
        out[begin:] = out[: begin - 1 if begin else None : -1]
        closed.clear()

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece; a piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.arcs) > self.max_arcs:
            self._forget()
        out: list[int] = []
        closed: list[int] = []
        state, arcs = 0, self.arcs
        for byte in piece:
            arc = arcs.get(state << 8 | byte)
            if arc is None:
                arc = self._arc(state, byte)
            state = arc[0]
            closed.append(arc[1])
            if arc[2]:
                self._settle(closed, out)
        self._settle(closed, out)
        return out


class Utf8Machine:
    """Incremental UTF-8: holds back the bytes of an unfinished character between feeds."""

    #: Bytes of the character that a lead byte announces; 1 also for bytes that lead nothing.
    NEEDS = bytes(2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 1 for b in range(256))

    def __init__(self) -> None:
        self.held = b""

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                keep = back if self.NEEDS[byte] > back else 0
                break
        cut = len(data) - keep
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def decode_stream(ids: Iterable[int], by_id: dict[int, bytes]) -> Iterator[str]:
    """Text of a stream of ids, piece by piece; characters split between tokens are joined."""
    machine, chunk = Utf8Machine(), []
    for token in ids:
        chunk.append(by_id[token])
        if len(chunk) == DECODE_CHUNK:
            yield machine.feed(b"".join(chunk))
            chunk = []
    yield machine.feed(b"".join(chunk))
    yield machine.finish()


class Codec:
    """Pattern split, transducer and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_pieces: int = CACHE_PIECES, most_arcs: int = CACHE_ARCS):
        import regex

        self.split = regex.compile(pattern).findall
        self.machine = MergeTransducer(ranks, most_arcs)
        self.most_pieces = most_pieces
        self.spelled: dict[str, str] = {}
        self.bytes_of = {str(rank): token for token, rank in ranks.items()}

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.split(text) for i in self.machine.encode(piece.encode())]

    def encode_spelled(self, text: str) -> list[str]:
        """Ids in decimal, by piece; pieces seen before come from a bounded cache."""
        known = self.spelled
        if len(known) > self.most_pieces:
            known.clear()
        out = []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = " ".join(map(str, self.machine.encode(piece.encode())))
                if len(piece) <= 40:
                    known[piece] = ids
            out.append(ids)
        return out

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of the ids, SHA-256 of what they decode to."""
        spelled = " ".join(self.encode_spelled(text)) if text else ""
        ids = spelled.split(" ") if spelled else []
        decoded, machine, bytes_of = hashlib.sha256(), Utf8Machine(), self.bytes_of
        for at in range(0, len(ids), DECODE_CHUNK):
            decoded.update(machine.feed(b"".join(map(bytes_of.__getitem__, ids[at : at + DECODE_CHUNK]))).encode())
        decoded.update(machine.finish().encode())
        return len(ids), hashlib.sha256(spelled.encode()).hexdigest(), decoded.hexdigest()


def codec(path: str, pattern: str, *most: int) -> Codec:
    """The codec of a rank file, one per worker process."""
    return worker_state(("bpe", path, pattern, most), lambda: Codec(load_ranks(path), pattern, *most))


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode_table(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every row's doc_id with token_ids (array of int) and the decoded text."""
    light_batches(docs.sparkSession)
    where, split = default_vocabulary()
    where, split = path or where, pattern or split

    def run(batches):
        import pyarrow as pa

        own = codec(where, split)
        by_id = own.machine.by_id
        for batch in batches:
            ids = [own.encode(t) if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(["".join(decode_stream(x, by_id)) for x in ids], pa.string())],
                names=["doc_id", "token_ids", "decoded"],
            )

    return docs.select("doc_id", text).mapInArrow(tidy(run), "doc_id long, token_ids array<int>, decoded string")


def digest_table(docs: DataFrame, path: str | None = None, pattern: str | None = None, most_pieces: int = CACHE_PIECES, most_arcs: int = CACHE_ARCS) -> DataFrame:
    """Every row's doc_id with n_tokens, ids_sha256 and decoded_sha256. The caches trade memory for time only."""
    light_batches(docs.sparkSession)
    where, split = default_vocabulary()
    where, split = path or where, pattern or split

    def run(batches):
        import pyarrow as pa

        own = codec(where, split, most_pieces, most_arcs)
        for batch in batches:
            rows = [own.digest(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
