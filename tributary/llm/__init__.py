"""Training-data operators: near-duplicates, secrets, packing, decontamination,
quality, URL lists, HTML, token counts. Nothing outside this folder imports it."""
