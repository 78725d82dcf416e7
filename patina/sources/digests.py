"""SHA-256 of a file in parts: what hashes one part, and goes on from the state of the part before.

``hashlib`` neither gives out its state nor takes one, so parts go through the public SHA256
functions of the OpenSSL library behind it. Their state is a plain struct.
"""

from __future__ import annotations

from collections.abc import Callable

STATE_BYTES = 112  # SHA256_CTX: 8 words of hash, 2 of length, 16 of an open block, 2 counts


def part_hasher(block: int) -> tuple[Callable, Callable]:
    """``able`` and ``hash_part``, nested so that Spark sends them to workers without this package."""
    state_bytes = STATE_BYTES

    def opened(path: str):
        from pyarrow import fs

        if path.startswith("file:"):
            return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
        system, inside = fs.FileSystem.from_uri(path)
        return system.open_input_file(inside)

    def library():
        import _hashlib
        import ctypes

        found = ctypes.CDLL(getattr(_hashlib, "__file__", None))
        found.SHA256_Init.argtypes = [ctypes.c_void_p]
        found.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
        found.SHA256_Final.argtypes = [ctypes.c_char_p, ctypes.c_void_p]
        return found

    def resumed(state: bytes | None):
        """Functions that take bytes, give the state and give the hex digest."""
        import ctypes

        openssl, held = library(), ctypes.create_string_buffer(state or b"", state_bytes)

        def must(done: int) -> None:
            if done != 1:
                raise RuntimeError("OpenSSL refused SHA-256")

        def digest() -> str:
            out = ctypes.create_string_buffer(32)
            must(openssl.SHA256_Final(out, held))
            return out.raw.hex()

        if state is None:
            must(openssl.SHA256_Init(held))
        return (lambda data: must(openssl.SHA256_Update(held, data, len(data)))), (lambda: held.raw), digest

    def able(path: str) -> tuple[bool, bool]:
        """Whether this worker can open the file, and whether it can hash in parts."""
        import hashlib

        import pyarrow as pa

        try:
            opened(path).close()
        except (OSError, pa.ArrowException):
            return False, False
        try:
            update, state, _ = resumed(None)
            update(b"a" * 100)
            update, _, digest = resumed(state())
            update(b"b" * 100)
            return True, digest() == hashlib.sha256(b"a" * 100 + b"b" * 100).hexdigest()
        except (AttributeError, OSError, RuntimeError):
            return True, False

    def hash_part(path: str, length: int, at: int, stop: int, state: bytes | None) -> tuple[bytes | None, str | None]:
        """Hash bytes ``at`` to ``stop``, and read no others: the state behind them, or at the end of the file its digest."""
        import hashlib

        if at == 0 and stop == length:
            whole = hashlib.sha256()
            update, digest = whole.update, whole.hexdigest
        else:
            update, left, digest = resumed(state)
        with opened(path) as stream:
            stream.seek(at)
            while at < stop:
                held = stream.read(min(block, stop - at))
                if not held:
                    raise EOFError(f"{path} was {length} bytes long and ends at {at}")
                update(held)
                at += len(held)
        return (None, digest()) if stop == length else (left(), None)

    return able, hash_part
