"""Public vocabularies.  Paths are parameters; files are read on the driver and their tables (tens of
thousands of entries, whatever the corpus) are sent to the tasks."""

from __future__ import annotations

TOKENIZERS = "/opt/tokenizers"
SENTENCE_PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
MARK = "▁"  # stands for a blank inside pieces


def read_pieces(path: str = SENTENCE_PIECES) -> dict[str, int]:
    """Ordinary pieces of a SentencePiece model, numbered from 0 in order of their ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    own = (sp.id_to_piece(i) for i in range(sp.get_piece_size())
           if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
    return {piece: i for i, piece in enumerate(dict.fromkeys(own))}
