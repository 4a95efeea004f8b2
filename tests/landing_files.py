"""Landing files for tests."""

import os


def write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for line in lines:
            f.write(line + "\n")
    return path
