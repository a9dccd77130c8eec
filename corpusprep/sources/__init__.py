"""corpusprep.sources"""
