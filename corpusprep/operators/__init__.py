"""corpusprep.operators"""
