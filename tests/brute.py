"""Message-at-a-time statement of the closing rules, to test against."""


def chunks_of(messages, rule, start=0):
    """messages: (offset, size, arrival) in offset order -> chunk rows."""
    out = []
    begin = end = start
    count = size = 0
    last = clock = rule.run_start_ms

    def commit(reason):
        nonlocal begin, count, size
        if begin != end:
            out.append((begin, end, count, size, reason))
        begin, count, size = end, 0, 0

    for offset, nbytes, arrival in messages:
        clock = max(clock, arrival)
        if rule.interval_ms is not None:
            while clock - last > rule.interval_ms:
                last += rule.interval_ms
                commit("interval")
        end = offset
        count += 1
        size += nbytes
        if rule.max_bytes is not None and size > rule.max_bytes:
            commit("size")
            last = clock
    due = rule.interval_ms is not None and rule.now_ms is not None
    if due and rule.now_ms - last > rule.interval_ms:
        commit("interval")
    commit("open")
    return out
