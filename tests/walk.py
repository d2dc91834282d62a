"""A repair of one pending entry after the other, as plain Python, to compare results with."""


def walk(replicas, pending, unique):
    """``replicas``: per replica {key: (unique value, time, note)}; ``pending``: [(id, key)].

    Returns (outcomes by id, replicas afterwards, backup rows as (id, replica, key, row,
    is standard)).
    """
    copies = [dict(r) for r in replicas]
    outcomes, backups = {}, []
    for id, key in sorted(pending):
        holders = [i for i, copy in enumerate(copies) if key in copy]
        rows = [copies[i][key] for i in holders]
        if unique and len({r[0] for r in rows}) > 1:
            outcomes[id] = 4
        elif len(rows) > 1 and len({r[1] for r in rows}) == 1:
            outcomes[id] = 5
        elif not rows:
            outcomes[id] = 2
        else:
            best = holders[0]
            for i in holders[1:]:
                if copies[i][key][1] > copies[best][key][1]:
                    best = i
            winner = copies[best][key]
            backups += [(id, i + 1, key, copies[i][key], int(i == best)) for i in holders]
            for copy in copies:
                if unique and winner[0] is not None:
                    for other in [k for k, r in copy.items() if r[0] == winner[0] and k != key]:
                        del copy[other]
                copy[key] = winner
            outcomes[id] = 1
    return outcomes, copies, backups
