"""Waveforms: decoding, slicing, resampling, spectra."""
