"""A speech model for tests: what a file says is written in its samples' number; masked audio is heard, or not, by name."""

import os

SAID = {"a": "see you on Monday", "b": "all is well", "c": "call Denver now", "d": "in March we go"}


def model():
    def hear(path: str, content: bytes) -> dict:
        name, again = os.path.basename(path).split(".")[0], "/" not in path
        if log := os.environ.get("FAKE_SPEECH_LOG"):  # a worker that began before the test does not have it
            with open(log, "a") as f:
                f.write(f"{name} {again}\n")
        if name == "broken" or again and name == "c":
            raise ValueError(f"cannot hear {name}")
        words = ["nothing", "here"] if again and name != "d" else SAID[name].split()
        return {"audio_duration": 2.0, "segments": [{"text": " ".join(words), "start": 0.0, "end": 2.0, "words": [{"word": f" {w} ", "start": k / 2, "end": k / 2 + 0.4} for k, w in enumerate(words)]}]}

    return hear
