"""Sequential models of the operators, one row at a time, to test against."""

from __future__ import annotations


def groups_by_size(sizes, limit):
    out, no, size = [], 0, None
    for s in sizes:
        if size is None or size + s > limit:
            no, size = no + 1, s
        else:
            size += s
        out.append(no)
    return out


def groups_within(times, n, span):
    out, no, count, first = [], 0, 0, None
    for t in times:
        if first is None or count == n or t >= first + span:
            no, count, first = no + 1, 0, t
        count += 1
        out.append(no)
    return out


def first_fit(sizes, limit):
    """Batches of one list: refused rows wait and are offered again in order."""
    numbers, pending, no = [None] * len(sizes), [i for i, s in enumerate(sizes) if s <= limit], 0
    while pending:
        no, room, refused = no + 1, limit, []
        for i in pending:
            if sizes[i] <= room:
                room -= sizes[i]
                numbers[i] = no
            else:
                refused.append(i)
        pending = refused
    return numbers


def buffered(n, capacity, strategy):
    """Positions left in a buffer after n arrivals."""
    buffer = []
    for e in range(n):
        if len(buffer) < capacity:
            buffer.append(e)
        elif strategy == "drop_head":
            buffer = buffer[1:] + [e]
        elif strategy == "drop_tail":
            buffer = buffer[:-1] + [e]
        elif strategy == "drop_buffer":
            buffer = [e]
    return buffer


def emitted(arrivals, costs, rate, burst):
    """Token bucket that starts full; rows leave in order. Seconds."""
    out, tokens, now = [], float(burst), None
    for t, c in zip(arrivals, costs):
        start = t if now is None else max(t, now)
        if now is not None:
            tokens = min(burst, tokens + (start - now) * rate)
        wait = max(0.0, (c - tokens) / rate)
        now = start + wait
        tokens = tokens + wait * rate - c
        out.append(now)
    return out


def settled(tags, actions):
    """Open deliveries of a channel are settled by actions in order."""
    state = {t: ("open", None) for t in tags}
    for seq, tag, action, multiple, requeue in sorted(actions):
        for t in tags:
            covered = t == tag or (multiple and t <= tag)
            if covered and state[t][0] == "open":
                outcome = "acked" if action == "ack" else "requeued" if requeue else "dropped"
                state[t] = (outcome, seq)
    return state


def topic_match(pattern, key):
    def go(p, k):
        if not p:
            return not k
        if p[0] == "#":
            return any(go(p[1:], k[i:]) for i in range(len(k) + 1))
        return bool(k) and (p[0] == "*" or p[0] == k[0]) and go(p[1:], k[1:])

    return go(pattern.split(".") if pattern else [], key.split(".") if key else [])


def fail_until(column, code="throttled"):
    """A transport for trials: a record fails while the attempt number is at most its ``column``."""
    return lambda: lambda records, attempt: [code if attempt <= r[column] else None for r in records]
