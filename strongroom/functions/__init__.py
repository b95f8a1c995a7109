from strongroom.functions.hashing import hash_diff, hash_key, normalise_key  # noqa: F401
