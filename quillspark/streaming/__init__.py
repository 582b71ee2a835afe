"""The transcription plan over a folder that receives files."""
