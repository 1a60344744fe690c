"""The pieces of a SentencePiece model file, as plain tables that can be broadcast."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEFAULT_PATH = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Vocab:
    """``pieces``: text to (id, score), with a plain space for the space mark; ``bytes_of``: the bytes an id stands for."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int] | None
    unk_id: int
    unk_score: float
    bytes_of: list[bytes]
    scores: np.ndarray
    longest: int
    #: Every beginning of a piece, with the (id, score) of those that are pieces themselves.
    begins: dict[str, tuple[int, float] | None]
    #: No piece goes on over a space after another character, so texts can be cut there.
    cuts_at_space: bool
    #: No piece of several characters has a line end.
    cuts_at_line: bool


def load(path: str = DEFAULT_PATH) -> Vocab:
    """Read the model file on the driver; control pieces are left out, so their texts are ordinary text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, table, scores = {}, [0] * 256, [], []
    for i in range(model.vocab_size()):
        piece, score = model.id_to_piece(i), model.get_score(i)
        scores.append(score)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            table.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            table.append(b"")
        else:
            text = piece.replace("▁", " ")
            table.append(text.encode())
            pieces[text] = (i, score)
    has_bytes = any(model.is_byte(i) for i in range(model.vocab_size()))
    least = min(s for _, s in pieces.values())
    begins: dict[str, tuple[int, float] | None] = {p[:n]: None for p in pieces for n in range(1, len(p))}
    return Vocab(
        pieces, byte_ids if has_bytes else None, model.unk_id(), least - 10, table, np.array(scores), max(map(len, pieces)), begins | pieces,
        not any(" " in p.lstrip(" ") for p in pieces), not any("\n" in p and len(p) > 1 for p in pieces),
    )
