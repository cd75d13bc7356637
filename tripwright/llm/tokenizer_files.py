"""Places of the public vocabulary files that the registered queries use; operators take a path."""

import public_tokenizers

WORD_LEVEL = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
