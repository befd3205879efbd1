"""Row-at-a-time models shared by the batch and stream tests."""


def count_window_model(rows, sizes):
    """Append, emit and slide, then clear on a reset; rows are (key, order, value, anomaly, command)."""
    held, epoch, number, out = {}, {}, {}, []
    for key, _, value, anomaly, command in sorted(rows, key=lambda r: r[1]):
        size, slide = sizes[key]
        held.setdefault(key, [])
        if not command:
            held[key].append(value)
            if len(held[key]) == size:
                window = held[key]
                out.append(
                    (key, epoch.get(key, 0), number.get(key, 0), sum(window) / size, sum(window), min(window), max(window))
                )
                number[key] = number.get(key, 0) + 1
                held[key] = window[min(slide, size):]
        if anomaly or command:
            held[key], number[key], epoch[key] = [], 0, epoch.get(key, 0) + 1
    return out
