"""Rating models trained as Spark ML jobs (see ``two_stage``) and latent views."""
