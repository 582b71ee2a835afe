"""Models from a folder or a hub id, by libraries that only the workers need."""

from __future__ import annotations

from ..sources.audio import load_samples
from .inference import ModelLoadError, dtype_of


class SpeechModel:
    """A sequence-to-sequence speech model of the transformers library, on the device and in the number type of the options."""

    def __init__(self, options: dict):
        self.options = options
        kind = dtype_of(options.get("dtype", "float32"))
        try:
            import torch
            import transformers
        except ImportError as e:
            raise ModelLoadError(f"workers need torch and transformers: {e}") from e
        self.torch, self.kind = torch, getattr(torch, kind)
        source, own = options["model"], {"local_files_only": bool(options.get("local"))}
        try:
            # the parts by themselves: a processor's own configuration may name its parts a second time
            features = transformers.WhisperFeatureExtractor.from_pretrained(source, **own)
            words = transformers.WhisperTokenizer.from_pretrained(source, **own)
            self.processor = transformers.WhisperProcessor(feature_extractor=features, tokenizer=words)
            model = transformers.WhisperForConditionalGeneration.from_pretrained(source, torch_dtype=self.kind, **own)
            self.model = model.to(options["device"]).eval()
        except Exception as e:
            raise ModelLoadError(f"{source} on {options['device']}: {e}") from e

    def transcribe_batch(self, paths: list[str]) -> list[str]:
        if not paths:
            return []
        rate = self.options["sampling_rate"]
        clips = [load_samples(p, rate) for p in paths]
        heard = self.processor(clips, sampling_rate=rate, return_tensors="pt").input_features.to(self.options["device"], self.kind)
        with self.torch.no_grad():
            ids = self.model.generate(heard, language=self.options["lang"], task=self.options["task"], max_new_tokens=self.options["max_new_tokens"])
        return self.processor.batch_decode(ids, skip_special_tokens=True)

    def free_memory(self) -> None:
        """After an out-of-memory error: what the library keeps for later goes back to the device."""
        if str(self.options["device"]).startswith("cuda"):
            self.torch.cuda.empty_cache()
