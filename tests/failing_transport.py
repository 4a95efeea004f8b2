"""Hand-off folder that refuses some batches, for failure drills."""

import gzip
from urllib.parse import parse_qs

from vigil.sources.event_sink import FileTransport


class FailingFolder(FileTransport):
    """``<folder>?fail=<k>`` answers every k-th batch of a task with 503, ``fail_match=<text>`` those that contain
    the text; ``status=<code>`` answers that code instead, ``times=<n>`` only on the first n attempts."""

    def __init__(self, argument):
        folder, _, query = argument.partition("?")
        options = {k: v[0] for k, v in parse_qs(query).items()}
        super().__init__(folder)
        self.every, self.status = int(options.get("fail", 0)), int(options.get("status", 503))
        self.text, self.times = options.get("fail_match", "").encode(), int(options.get("times", 1 << 30))
        self.failed = {}

    def post(self, batch_id, payload, n_events):
        n = int(batch_id.rsplit("-", 1)[1])
        if self.every and n % self.every == self.every - 1 or self.text and self.text in gzip.decompress(payload):
            self.failed[batch_id] = self.failed.get(batch_id, 0) + 1
            if self.failed[batch_id] <= self.times:
                return self.status
        return super().post(batch_id, payload, n_events)
