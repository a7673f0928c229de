"""Where the public tokenizers' files lie. They are installed on every node and never copied into this library."""

from __future__ import annotations


def vocabulary(name: str) -> str:
    """The place of a file of the installed ``public_tokenizers`` package."""
    import public_tokenizers

    return public_tokenizers.path(name)
