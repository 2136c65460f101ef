"""Plain sequential models of the rules, to compare the operators with."""

from __future__ import annotations


class Limiter:
    """One counter of leased tokens per tenant and one of used quota per tenant and window."""

    def __init__(self, limit, lease=1, window_sec=1, idle_ttl_sec=None):
        self.limit, self.lease = limit, lease
        self.window_sec, self.idle = window_sec, idle_ttl_sec
        self.tokens, self.last, self.used = {}, {}, {}

    def allow(self, tenant, second, n=1):
        if n <= 0:
            return True
        tenant = tenant or "default"
        if self.idle is not None and second - self.last.get(tenant, second) > self.idle:
            self.tokens[tenant] = 0
        self.last[tenant] = second
        held = self.tokens.get(tenant, 0)
        if held >= n:
            self.tokens[tenant] = held - n
            return True
        cell = (tenant, second // self.window_sec)
        granted = min(max(self.limit - self.used.get(cell, 0), 0), max(self.lease, n))
        self.used[cell] = self.used.get(cell, 0) + granted
        if granted < n:
            self.tokens[tenant] = 0
            return False
        self.tokens[tenant] = granted - n
        return True


class Buffers:
    """Shards that take rows one by one (two choices) or batches (one choice, a prefix)."""

    def __init__(self, shards, per_shard):
        self.load, self.per_shard, self.turn = [0] * shards, per_shard, 0

    def submit(self):
        self.turn += 1
        for step in range(2):
            shard = (self.turn + step) % len(self.load)
            if self.load[shard] < self.per_shard:
                self.load[shard] += 1
                return True
        return False

    def submit_batch(self, n):
        self.turn += 1
        shard = self.turn % len(self.load)
        taken = min(n, self.per_shard - self.load[shard])
        self.load[shard] += taken
        return taken
