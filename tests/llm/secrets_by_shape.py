"""Secrets and things that look a little like them, of shapes and in wordings that the base patterns do not match."""

import base64
import random
import string
import uuid

LETTERS = string.ascii_letters + string.digits


def some(rng: random.Random, n: int, letters: str = LETTERS) -> str:
    return "".join(rng.choice(letters) for _ in range(n))


SECRETS = {
    "personal access": lambda r: "ghp_" + some(r, 36),
    "live key": lambda r: "sk_live_" + some(r, 24),
    "chat bot": lambda r: "xoxb" + some(r, 12, string.digits) + some(r, 24),
    "hex in capitals": lambda r: some(r, 32, "0123456789ABCDEF"),
    "base64": lambda r: base64.b64encode(r.randbytes(30)).decode().replace("+", "A").replace("/", "b"),
    "maps key": lambda r: "AIza" + some(r, 35),
    "web token part": lambda r: "eyJ" + some(r, 45),
    "random letters": lambda r: some(r, 28),
}
OTHERS = {
    "date": lambda r: f"20{r.randrange(10, 30)}-{r.randrange(1, 13):02d}-{r.randrange(1, 29):02d}",
    "version": lambda r: f"v{r.randrange(9)}.{r.randrange(20)}.{r.randrange(20)}",
    "identifier": lambda r: r.choice(["getUserById2", "parseHTML5", "utf8_decode", "index_v2", "sha256sum", "int32_t"]),
    "product": lambda r: r.choice(["RTX4090", "A320neo", "iPhone15", "x86_64", "MP3", "H2SO4", "B2B", "covid19"]),
    "phone": lambda r: "+49 " + some(r, 3, string.digits) + " " + some(r, 7, string.digits),
    "price": lambda r: f"{r.randrange(1, 9)},{some(r, 3, string.digits)}.99",
    "long word": lambda r: r.choice(["internationalization", "Donaudampfschifffahrt", "counterrevolutionary"]),
    "id": lambda r: str(uuid.UUID(int=r.getrandbits(128)))[:13],
}
FRAMES = ("the key {} was found", "use {} to log in", "Bearer {}", "curl -u {} http", "credential {} expires", "see {} there", "{}", "he wrote {} on it")


def documents(rng: random.Random, prose, kinds, n: int) -> list[tuple[str, str, str]]:
    """(kind, text, what stands in it)."""
    out = []
    for name, make in kinds.items():
        for _ in range(n):
            thing = make(rng)
            out.append((name, f"{prose(rng, 25)} {rng.choice(FRAMES).format(thing)} {prose(rng, 25)}", thing))
    return out
