"""Row-by-row models of the feeds, written from the rules and not from the library."""

import hashlib


def norm(row, cols):
    return "*#*".join(
        ("" if row[c] is None else str(row[c])).upper().strip(" ") for c in cols
    )


def type1(source, target, sid, compared):
    """[(action, source row, target row or None)]"""
    out = []
    for s in source:
        matches = [t for t in target if s[sid] is not None and t[sid] == s[sid]]
        if not matches:
            out.append(("I", s, None))
        for t in matches:
            if norm(s, compared) != norm(t, compared):
                out.append(("U", s, t))
    return out


def type2(source, target, dim, type1_cols, type2_cols):
    """[(branch, source row, target row or None)]"""
    out = []
    for s in source:
        matches = [t for t in target if s[dim] is not None and t[dim] == s[dim]]
        if not matches:
            out.append(("open", s, None))
        for t in matches:
            new_version = norm(s, type2_cols) != norm(t, type2_cols)
            other = norm(s, type1_cols) != norm(t, type1_cols)
            if t["CURRENT_IND"] == "Y" and new_version:
                out.append(("open", s, t))
                out.append(("close", s, t))
            if other and (t["CURRENT_IND"] == "N" or (t["CURRENT_IND"] == "Y" and not new_version)):
                out.append(("overwrite", s, t))
    return out


def newest(rows, key, epoch):
    """(kept, stale)"""
    best = {}
    for r in rows:
        k = tuple(r[c] for c in key)
        if None not in k and r[epoch] is not None:
            best[k] = max(best.get(k, r[epoch]), r[epoch])
    kept, stale = [], []
    for r in rows:
        k = tuple(r[c] for c in key)
        good = None not in k and r[epoch] is not None and best[k] == r[epoch]
        (kept if good else stale).append(r)
    return kept, stale


def sid64(text):
    if not text:
        return 0
    return int.from_bytes(hashlib.sha1(text.encode()).digest()[-8:], "big", signed=True)


def hash_history(source, target, key, attributes):
    """Next (key, attributes, version, current) rows; source keys are unique."""

    def values(row):
        return "|".join("" if row[c] is None else str(row[c]) for c in attributes)

    out, ended = [], set()
    for s in source:
        mine = [t for t in target if s[key] is not None and t[key] == s[key]]
        live = [t for t in mine if t["is_current"]]
        differing = [t for t in live if values(t) != values(s)]
        for _ in differing if live else [None]:
            version = max((t["version"] for t in mine), default=0) + 1
            out.append((s[key], values(s), version, True))
        if differing:
            ended.add(s[key])
    for t in target:
        current = t["is_current"] and t[key] not in ended
        out.append((t[key], values(t), t["version"], current))
    return out
