import random


def prose(seed: int, words: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) + ("." if i % 9 == 8 else "") for i in range(words))
