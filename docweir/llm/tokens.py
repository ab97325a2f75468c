"""Token ids of texts by a public byte-level BPE vocabulary file."""

from __future__ import annotations

from docweir.functions.tokens import Encoder, encoder

__all__ = ["VOCABULARY", "Encoder", "default_path", "encoder"]

#: The vocabulary file of the registered queries; any path can be given instead.
VOCABULARY = "byte_bpe_50k.json"


def default_path() -> str:
    """Where the installed vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)
